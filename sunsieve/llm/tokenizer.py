"""Public tokenizers inside tasks: each distinct word is encoded once and then looked up.

Ids travel as little-endian unsigned 32-bit integers in one binary value, which is what token
files hold and what Spark's own `crc32` and `sha2` take.
"""

import base64
import itertools
import os
import string
from collections.abc import Callable, Iterable
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import regex

#: Entries that a table of known words keeps, and one of known parts of words, so that a worker's memory is bounded.
KNOWN, KNOWN_PARTS = 200_000, 100_000
#: Marks, a byte each, of pieces that were met once.
MARKED = 1 << 22
#: Characters of a text that are looked up at once.
SPAN = 1 << 20

#: ASCII characters that are neither letters, digits nor white space.
MARKS = string.punctuation

#: A space between two words: both tokenizer patterns always split before it.
_BETWEEN = regex.compile(r"(?<=\S) (?=\S)")


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, dtype="<u4").tobytes()


def spans(text: str, most: int = SPAN) -> list[str]:
    """The text cut before spaces between words, in parts of about `most` characters."""
    if len(text) <= most:
        return [text]
    out, start = [], 0
    while len(text) - start > most and (found := _BETWEEN.search(text, start + most)):
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


class Known(dict):
    """Pieces already encoded, as bytes of ids; `encode` turns a list of pieces into such bytes.

    Most pieces are met once and never again. A piece stays from the second call on that meets it,
    as a mark at its hash tells, until `most` stay; all others are kept until the next call only.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = KNOWN):
        super().__init__()
        self.encode, self.most = encode, most
        self.passing: dict[str, bytes] = {}
        self.marks = bytearray(MARKED)

    def __missing__(self, piece: str) -> bytes:
        return self.passing[piece]

    def learn(self, lists: Iterable[list[str]]) -> None:
        """Encode what the lists hold and is not known yet, in one call."""
        met: set[str] = set()
        for pieces in lists:
            met.update(pieces)
        new = [x for x in met if x not in self]
        self.passing = dict(zip(new, self.encode(new))) if new else {}
        if len(self) < self.most:
            marks = self.marks
            for piece in new:
                at = hash(piece) & (MARKED - 1)
                if marks[at]:
                    self[piece] = self.passing[piece]
                else:
                    marks[at] = 1


class WordBpe:
    """A `tokenizers` file that drops white space and ends each word with an end-of-word token.

    Words between white space are independent, and so are a run of letters and the ASCII marks
    behind it. New runs of letters are encoded many at a time and cut at the end-of-word tokens.
    Special tokens written out in a text become their ids, as the library does by default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.ends = np.zeros(self.model.get_vocab_size(), dtype=bool)
        self.ends[[i for x, i in self.model.get_vocab().items() if x.endswith("</w>")]] = True
        self.letters = Known(self._encode_letters, KNOWN_PARTS)
        self.words = Known(self._encode_words)

    def _encode_each(self, pieces: list[str]) -> list[bytes]:
        return [packed(x.ids) for x in self.model.encode_batch_fast(pieces, add_special_tokens=False)]

    def _encode_letters(self, runs: list[str]) -> list[bytes]:
        out = []
        for start in range(0, len(runs), 200):
            part = runs[start : start + 200]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                out += [ids[a:b].tobytes() for a, b in zip([0, *cuts[:-1]], cuts)]
            else:
                out += self._encode_each(part)
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        runs, rests = [], []  # what stands before the marks, None if it is no plain run of letters
        for word in words:
            run = word.rstrip(MARKS)
            lower = run.lower()  # only to meet fewer runs: the tokenizer lowers each character itself
            if run.isalpha() and len(lower) == len(run) and (word.isascii() or is_normalized("NFC", word)):
                runs.append(run if "\u03a3" in run else lower)
                rests.append(word[len(run) :])
            else:
                runs.append(None)
                rests.append(word)
        self.letters.learn([[run for run in runs if run]])
        others = {"": b""}
        if rest := [x for x in dict.fromkeys(rests) if x]:
            others |= zip(rest, self._encode_each(rest))
        return [others[x] if run is None else self.letters[run] + others[x] for run, x in zip(runs, rests)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        parts = [[p.replace("\n", " ").split(" ") for p in spans(x)] for x in texts]
        self.words.learn(itertools.chain.from_iterable(parts))
        get = self.words.__getitem__
        return [b"".join(itertools.chain.from_iterable(map(get, p) for p in x)) for x in parts]


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of byte strings and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    """One per Python worker, which keeps what it has learnt from task to task."""
    return WordBpe(path)


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    return public_tokenizers.path(name)
