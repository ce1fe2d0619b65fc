import numpy as np
import pytest
from pyspark.sql import functions as F

from sunsieve.llm import bond, queries
from sunsieve.llm.bond import Block, best_of, hard_negatives, inside


def mined(rows, is_anchor, positives=5, negatives=3, window=(50, 95)):
    """All of it with plain loops: rows are (id, label, integers)."""
    out = set()
    for a, la, va in {(i, l, tuple(v)) for i, l, v in rows if is_anchor(i)}:
        best = {}
        for i, l, v in rows:
            if i != a:
                best[i, l] = max(best.get((i, l), -(2**70)), sum(x * y for x, y in zip(va, v)))
        own = sorted((-s, i) for (i, l), s in best.items() if l == la)[:positives]
        for s, p in own:
            others = {}
            for (i, l), t in best.items():
                if l != la and window[0] * -s <= 100 * t <= window[1] * -s:
                    others[i] = max(t, others.get(i, t))
            for k, (t, i) in enumerate(sorted((-t, i) for i, t in others.items())[:negatives]):
                out.add((a, p, k + 1, i, -s, -t))
    return out


def frame(spark, rows):
    schema = "vec_id long, embedding array<double>, label int, block string, ids string, chunk string"
    return spark.createDataFrame([(i, v, l, "x", "y", "z") for i, l, v in rows], schema).repartition(3)


def found(df, **more):
    got = hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), **more)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block, chunk, stride", [(8192, 256, 8), (40, 7, 3), (1, 1, 1)])
def test_equals_plain_loops(spark, monkeypatch, block, chunk, stride):
    monkeypatch.setattr(bond, "BLOCK", block)
    monkeypatch.setattr(bond, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    n = 120 if block > 1 else 25
    # Few values, so that scores tie; one label holds a third of all.
    rows = [(int(i), int(rng.choice([0, 0, 1, 2, 3])), [float(x) for x in rng.integers(-4, 9, 11)]) for i in range(n)]
    rows += [(200 + k, 1, rows[0][2]) for k in range(6)]  # copies of an anchor under other ids
    whole = [(i, l, [int(x) for x in v]) for i, l, v in rows]
    assert found(frame(spark, rows), scale=1) == mined(whole, lambda i: i % 10 == 0)


def test_scan_keeps_what_no_bound_excludes():
    rng = np.random.default_rng(2)
    v = rng.integers(-100, 100, (500, 16))
    block = Block(np.arange(500, dtype="<i8").tobytes(), np.zeros(500, "<i4").tobytes(), [c.astype("<i4").tobytes() for c in v.T])
    anchor = rng.integers(-100, 100, 16)
    want = v @ anchor
    for stride in (1, 5, 16):
        alive, score = block.scan(anchor, np.arange(500), best_of(4), stride)
        assert set(np.argsort(-want)[:4]) <= set(alive) and (score == want[alive]).all()
        windows = np.array([[10_000, 30_000], [-5_000, 2_000]])
        alive, score = block.scan(anchor, np.arange(500), inside(windows, 3), stride)
        assert len(alive) < 500 and (score == want[alive]).all()
        for low, high in windows:
            fit = [i for i in np.argsort(-want, kind="stable") if low <= want[i] <= high]
            assert set(fit[:3]) <= set(alive)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [10.0, 0.0]), (1, 1, [9.0, 1.0]), (1, 1, [9.0, 1.0]), (1, 1, [3.0, 1.0]), (2, 2, [7.0, 2.0]), (3, 2, [8.0, 5.0])]
    rows += [(2, 2, [7.0, 2.0]), (0, 2, [8.0, 0.0]), (4, None, [8.0, 0.0]), (5, 2, None), (6, 2, [8.0, nan]), (7, 2, [inf, 1.0])]
    rows += [(8, 2, [8.0, None]), (None, 2, [8.0, 0.0]), (9, 2, [8.0]), (11, 3, [0.0, 0.0]), (0, 1, [10.0, 0.0])]
    got = found(frame(spark, rows), scale=1)
    # Anchor 0 twice under label 1 and once under 2; its own id is no negative of it.
    kept = [(i, l, [int(x) for x in v]) for i, l, v in rows if None not in (i, l, v) and len(v) == 2 and None not in v and np.isfinite(v).all()]
    assert got == mined(kept, lambda i: i % 10 == 0)
    assert (0, 1, 1, 3, 90, 80) in got
    empty = frame(spark, rows).limit(0)
    assert not found(empty) and not found(frame(spark, [(1, 1, [1.0])]))
    # One row alone has neither positives nor negatives.
    assert not found(frame(spark, [(0, 1, [1.0])]))


def test_scores_beyond_64_bits_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        found(frame(spark, [(0, 1, [1e12]), (1, 1, [1.0])]))


def test_query_against_plain_loops(spark):
    rows = []
    for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect():
        if r.label is None or r.embedding is None or not all(x is not None and np.isfinite(x) for x in r.embedding):
            continue
        label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
        rows.append((r.vec_id, label, [int(np.floor(256 * float(x))) for x in r.embedding]))
    got = queries.op11_bond_negatives(spark, "/root/testdata/sf0.001")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert {tuple(r) for r in got.collect()} == mined(rows, lambda i: i % 50 == 0)
