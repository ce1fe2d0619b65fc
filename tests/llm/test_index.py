import numpy as np
import pytest
from pyspark.sql import functions as F

from sunsieve.llm import multi_index
from sunsieve.llm.multi_index import neighbours, traverse


def exact(ids, v, q, k):
    scores = v @ v[q]
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[q]]
    return [(int(ids[i]), float(scores[i])) for i in order[:k]]


def test_pairs_come_by_falling_sums():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=9), rng.normal(size=7)
    found = list(traverse((a, b)))
    assert [s for s, _, _ in found] == pytest.approx(np.sort((a[:, None] + b[None, :]).ravel())[::-1])
    assert len({(i, j) for _, i, j in found}) == 63 and all(s == pytest.approx(a[i] + b[j]) for s, i, j in found)


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(30, 16))
    v = np.concatenate([centers[rng.integers(0, 30, 2500)] + rng.normal(size=(2500, 16)), np.repeat(centers[:1], 300, axis=0)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = np.arange(len(v))
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in neighbours(df, F.col("vec_id") % 50 == 0, 10).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, len(v), 50):
        want, found = exact(ids, v, q, 10), [got[q][k] for k in range(1, 11)]
        hits += len({i for i, _ in want} & {i for i, _ in found})
        assert all(s == pytest.approx(v[i] @ v[q], abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
    assert hits >= 0.95 * 10 * len(range(0, len(v), 50))
    # The copies tie with each other: the smallest ids win.
    assert [got[2550][k][0] for k in range(1, 11)] == list(range(2500, 2510))


def test_blocks_split_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 40)
    v = np.concatenate([np.tile([[1.0, 0, 0, 0]], (200, 1)), np.eye(4)[1:].repeat(3, axis=0)])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    found = neighbours(df, F.col("vec_id") == 5, 7).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in found] == [(k + 1, i, 1.0) for k, i in enumerate([0, 1, 2, 3, 4, 6, 7])]


def test_an_id_repeated_more_than_k_times_leaves_room_for_others(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([[[1.0, 0, 0, 0]], [[1.0, 0.1, 0, 0]], rng.normal(size=(60, 4)) * 0.1 + [0.8, 0, 0, 0]])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    # One id 30 times, one with 20 different vectors, and every row twice.
    many = [*rows, *rows, *[rows[1]] * 30, *((2, [0.9 + j / 1000, 0.0, 0.0, 0.0]) for j in range(20))]
    df = spark.createDataFrame(many, "vec_id long, embedding array<double>").repartition(3)
    best = {}
    for i, x in many:
        if i:
            best[i] = max(best.get(i, -9.0), float(np.dot(x, v[0])))
    want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:7]
    found = neighbours(df, F.col("vec_id") == 0, 7).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [i for i, _ in want]
    assert [r.score for r in found] == pytest.approx([s for _, s in want])


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, nan]), (2, None), (3, [0.0, 0.0]), (4, [inf, 1.0]), (5, [1.0]), (6, [1.0, None])]
    rows += [(7, [2.0, 1.0]), (7, [2.0, 1.0]), (None, [9.0, 9.0]), (20, [1.0, 1.0]), (8, [-1.0, 3.0]), (9, [-inf, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cell string")
    found = neighbours(df, F.col("vec_id") % 20 == 0, 20).collect()
    want = {(0, 1, 8, 5.0), (0, 2, 7, 4.0), (0, 3, 20, 3.0), (20, 1, 0, 3.0), (20, 2, 7, 3.0), (20, 3, 8, 2.0)}
    assert len(found) == 6 and {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == want
    assert neighbours(df.limit(0), F.lit(True), 5).isEmpty()
    assert neighbours(df.where("vec_id = 0"), F.lit(True), 5).isEmpty()
