import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from odd import documents
from sunsieve.llm import queries
from sunsieve.llm.mixing import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Excess reshared by weight until no target is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = share * sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in names}
    full = set()
    while over := {s for s in names if target[s] > most * sizes[s]} - full:
        full |= over
        excess = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else excess * weight[s] / rest for s in names}
    return target


def plain_tilt(sizes, target, most=2):
    """By bisection: the number at which min(most, exp(tilt * size / mean)) takes the target."""
    sizes = [x for x in sizes if x]
    if target >= most * sum(sizes):
        return math.inf
    mean = sum(sizes) / len(sizes)
    low, high = -1e6, 1e6
    for _ in range(200):
        tilt = (low + high) / 2
        taken = sum(x * min(most, math.exp(min(700, tilt * x / mean))) for x in sizes)
        low, high = (tilt, high) if taken < target else (low, tilt)
    return low


def check(rows, slack_words=None):
    """Every promise of the mix, against plain Python: rows as returned."""
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    target = plain_targets({s: sum(r["size"] for r in x) for s, x in by.items()})
    for s, own in by.items():
        size = sum(r["size"] for r in own)
        sizes = sorted({r["size"] for r in own if r["size"]}) or [0]
        tilt = plain_tilt([r["size"] for r in own], target[s]) if size else 0
        mean = size / max(1, sum(r["size"] > 0 for r in own))
        for r in own:
            assert r.source_size == size and r.target == pytest.approx(target[s], rel=1e-12)
            assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
            if r["size"]:
                assert r.rate == pytest.approx(min(2.0, math.exp(min(700, tilt * r["size"] / mean))), rel=1e-3)
            else:
                assert (r.rate, r.copies) == (1.0, 1)
        # Off by about half of the shortest document, unless rates at a bound leave no room.
        assert abs(sum(r.taken for r in own) - target[s]) <= (slack_words or max(sizes[-1] / 2, 1.0))


def corpus(spark, rows):
    schema = "doc_id long, text string, source string, size string, rate string, n string, `by` string, target string"
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema).repartition(3)


def made(n=600):
    rows = []
    for i in range(n):
        source = ["a", "a", "a", "é", "B", None, "z"][i % 7]
        rows.append((i, " ".join(["w"] * (1 + (i * i * 31 + 7 * i) % 90 + (3000 if i % 200 == 3 else 0))), source))
    return rows


def test_targets_rates_and_copies(spark):
    rows = made()
    got = mix(corpus(spark, rows)).collect()
    sizes = {i: len(t.split()) for i, t, _ in rows}
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter((i, sizes[i], s) for i, _, s in rows)
    check(got)
    for s in ("a", "z"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2


def test_runs_agree_whatever_the_partitions(spark):
    def taken(df):
        return sorted((r.doc_id, r.taken) for r in mix(df, head=5, slice_rows=7).collect())

    df = corpus(spark, made(300))
    first = taken(df)
    assert taken(df.repartition(1)) == first and taken(df.orderBy(F.desc("doc_id")).repartition(9)) == first


def test_a_large_group_of_equals_is_dealt_in_slices(spark):
    rows = [(i, "one two three four", "hot") for i in range(500)] + [(600 + i, "w " * (i + 1), "b") for i in range(40)]
    rows += [(700 + i, "w " * (i + 1), "c") for i in range(60)]
    got = mix(corpus(spark, rows), slice_rows=10).collect()
    check(got)
    hot = Counter(r.copies for r in got if r.source == "hot")
    assert len(hot) == 2 and sum(hot.values()) == 500
    # Cells behind the head are rounded by a running sum: off by the longest of them.
    check(mix(corpus(spark, made(400)), head=2, slice_rows=10).collect(), slack_words=3100)


def test_odd_documents(spark):
    docs = documents(spark)
    got = mix(docs).collect()
    want = Counter((r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == want
    check(got, slack_words=10**6)
    assert mix(docs.limit(0)).isEmpty()
    none = mix(docs.where("doc_id = 2")).collect()
    assert [(r["size"], r.target, r.taken) for r in none] == [(0, 0.0, 0)]


def test_query_keeps_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = queries.op12_entropy_mixing(spark, sf).collect()
    want = Counter((d.doc_id, len(WORD.findall(d.text or "")), d.source) for d in docs)
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == want
    check(got)


def test_only_built_in_columns(spark):
    plan = mix(corpus(spark, made(50)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
