"""Byte-level BPE through a sentencepiece model that is written from the vocabulary alone.

Each byte stands for a printable character, so a token's bytes become a piece of text; its score is
the negative rank and the normaliser is the identity. Sentencepiece then merges the pair with the
best score, leftmost first, which is the merge order of the ranks.
"""

import itertools
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, runs, text_of
from sunsieve.llm.tokenizer import KNOWN_PARTS, Known, packed, read_ranks, spans

NORMAL, UNKNOWN, BPE = 1, 2, 2


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if it is visible, else one from U+0100 on."""
    spare = itertools.count(0x100)
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return [chr(b if b in visible else next(spare)) for b in range(256)]


#: For `str.translate` on bytes read as Latin-1.
TO_PIECE = dict(enumerate(byte_characters()))


def as_piece(raw: bytes) -> str:
    return raw.decode("latin-1").translate(TO_PIECE)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: piece i has rank i, then the unknown piece.

    Field numbers are those of the published sentencepiece_model.proto. Ranks must be 0..n-1.
    """
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[x] for x in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    out = []
    for rank, raw in enumerate(by_rank):
        score = _varint(2 << 3 | 5) + struct.pack("<f", -rank)
        out.append(_bytes(1, _bytes(1, as_piece(raw).encode()) + score + _number(3, NORMAL)))
    unknown = _bytes(1, "".encode()) + _varint(2 << 3 | 5) + struct.pack("<f", 0.0)
    out.append(_bytes(1, unknown + _number(3, UNKNOWN)))
    trainer = _number(3, BPE) + _number(4, len(by_rank) + 1) + _number(40, len(by_rank))
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*out, _bytes(2, trainer), _bytes(3, normalizer)])


class ByteBpe:
    """Encodes pre-tokens with the model and decodes by the inverse of the byte characters."""

    def __init__(self, path: str, pattern: str):
        from sentencepiece import SentencePieceProcessor

        self.ranks = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.bytes_of = sorted(self.ranks, key=self.ranks.__getitem__)
        self.pattern = regex.compile(pattern)
        self.tokens = Known(self._encode_tokens, KNOWN_PARTS)
        #: Words with the space before them; None for those that may join their neighbours.
        self.words = Known(self._encode_words)

    def _encode_tokens(self, tokens: list[str]) -> list[bytes]:
        raw = [x.encode() for x in tokens]
        whole = [self.ranks.get(x) for x in raw]  # a token of the vocabulary stands for itself
        rest = iter(self.model.encode([as_piece(x) for x, k in zip(raw, whole) if k is None]))
        return [packed([k] if k is not None else next(rest)) for k in whole]

    def _split(self, texts: list[str]) -> list[bytes]:
        lists = [self.pattern.findall(x) for x in texts]
        self.tokens.learn(lists)
        get = self.tokens.__getitem__
        return [b"".join(map(get, x)) for x in lists]

    def _encode_words(self, words: list[str]) -> list[bytes | None]:
        bare = [x[1:] for x in words]
        sure = [bool(x) and not (x[0].isspace() or x[-1].isspace()) for x in bare]
        ids = iter(self._split([w[w[0] == "\0" :] for w, s in zip(words, sure) if s]))
        return [next(ids) if s else None for s in sure]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        parts = []  # NUL marks the word that has no space before it
        for x in texts:
            for k, part in enumerate(spans(x)):
                if k:
                    part = part[1:]
                words = part.split(" ")
                lead = " " if k else "\0"
                parts.append([lead + words[0], *(f" {w}" for w in words[1:])])
        self.words.learn(parts)
        out, at = [], iter(parts)
        for x in texts:
            own = list(itertools.islice(at, len(spans(x))))
            found = [list(map(self.words.__getitem__, words)) for words in own]
            if any(None in f for f in found):
                found = [self._split(spans(x))]
            out.append(b"".join(itertools.chain.from_iterable(found)))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> ByteBpe:
    """One per Python worker."""
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary, unsigned 32-bit little-endian) and decoded (binary) of each whole text.

    A null text is empty and has no ids; a null doc_id is kept; repeated rows give repeated rows;
    other columns are not read. Texts are encoded one stretch at a time, whatever their length.
    No shuffle: a row needs nothing but itself.
    """

    def step(batches: Batches) -> Batches:
        own = codec(vocabulary, pattern)
        for batch in batches:
            for run in runs(batch, "text"):
                ids = own.encode(run.column("text").to_pylist())
                back = [own.decode(x) for x in ids]
                columns = [run.column("doc_id"), pa.array(ids, pa.binary()), pa.array(back, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(step, "doc_id long, ids binary, decoded binary")
