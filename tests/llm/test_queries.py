"""The registered queries' own columns on a small table, against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_duplicates import brute
from tokenizers import Tokenizer

from sunsieve.llm import queries
from sunsieve.llm.tokenizer import packed, read_ranks, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def bytes_model():
    ranks = read_ranks(vocabulary("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op2_scores_and_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in rows if r.embedding and None not in r.embedding]
    vectors = {i: v for i, v in rows if np.isfinite(v).all() and v.any()}
    ids = np.array(sorted(vectors))
    every = np.array([vectors[i] for i in ids])
    found = defaultdict(list)
    for r in queries.op2_inverted_multi_index(spark, SF).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r)
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for q, got in found.items():
        scores = every @ vectors[q]
        best = [int(ids[k]) for k in np.lexsort((ids, -scores)) if ids[k] != q][:20]
        assert [r["rank"] for r in got] == list(range(1, 21)) and q not in {r.vec_id for r in got}
        assert all(r.score == pytest.approx(vectors[q] @ vectors[r.vec_id], abs=1e-12) for r in got)
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        hits += len(set(best) & {r.vec_id for r in got})
    assert hits >= 0.95 * 20 * len(found)


def test_op7_ids_and_round_trip(spark, docs, bytes_model):
    want = Counter()
    for doc_id, text in docs:
        ids = bytes_model.encode_ordinary(text)
        raw = np.array(ids, dtype="<u4").tobytes()
        want[doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    found = queries.op7_byte_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(map(tuple, found.collect())) == want


def test_op8_pieces_and_sequences(spark, docs):
    model = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = {d: packed([*model.encode(t, add_special_tokens=False).ids, 2]) for d, t in docs}
    assert len(ids) == len(docs)
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op8_hierarchical_packing(spark, SF).collect():
        raw = ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id]) // 4 and r.ids_crc32 == zlib.crc32(raw)
        parts[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces, whole in ((parts, {d: len(x) // 4 for d, x in ids.items()}), (sequences, None)):
        for key, cuts in pieces.items():
            at = 0
            for start, length in sorted(cuts):
                assert start == at
                at += length
            assert at <= 4096 if whole is None else at == whole[key]
    used = [sum(n for _, n in x) for x in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in used)
    assert set(parts) == set(ids) and padding < 4096


def test_op9_sizes_and_components(spark, docs):
    found = queries.op9_ngram_join(spark, SF).select("doc_id", "n_shingles", "component_id")
    assert Counter(map(tuple, found.collect())) == Counter(brute(docs))


def test_op1_counts_whole_documents(spark, docs, bytes_model):
    found = queries.op1_separator_scan(spark, SF).collect()
    counts = {r.doc_id: r for r in found}
    assert len(found) == len(docs) and re.search("token", " ".join(found[0].asDict()))
    name = next(c for c in found[0].asDict() if "tokens" in c)
    for doc_id, text in docs:
        assert counts[doc_id][name] - len(bytes_model.encode_ordinary(text)) in (0, 1)
