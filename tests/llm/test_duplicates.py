import random
import re
from collections import Counter

import numpy as np
import odd
import pyarrow as pa
import pytest

from sunsieve.llm import ngram_join
from sunsieve.llm.components import components
from sunsieve.llm.ngram_join import near_duplicates
from sunsieve.llm.shingles import shingle_sets, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs of rows."""
    sets = [plain_set(t) for _, t, *_ in rows]
    name = list(range(len(rows)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                name[find(i)] = find(j)
    best = {}
    for i, (doc, *_) in enumerate(rows):
        ids = [x for x in (best.get(find(i)), doc) if x is not None]
        best[find(i)] = min(ids, default=None)
    return Counter((doc, len(s), best[find(i)] if s else doc) for i, ((doc, *_), s) in enumerate(zip(rows, sets)))


def found(spark, rows, **bounds):
    df = spark.createDataFrame([(d, t) for d, t, *_ in rows], "doc_id long, text string").repartition(5)
    return Counter(tuple(r) for r in near_duplicates(df, counters=1 << 12, **bounds).collect())


def mutated(rnd, base, n):
    out = list(base)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.random()}"
    return " ".join(out)


@pytest.mark.parametrize("bounds", [{}, {"crowd": 3, "block": 2}])
def test_groups_are_those_of_all_pairs(spark, bounds):
    rnd = random.Random(4)
    rows = []
    passage = [f"p{i}" for i in range(30)]
    for g in range(12):
        base = [f"w{g}_{rnd.randrange(400)}" for _ in range(rnd.choice([6, 40, 120, 300]))]
        if g % 3 == 0:
            base[10:10] = passage
        for _ in range(rnd.randint(1, 14)):
            rows.append((len(rows) + 1, mutated(rnd, base, rnd.randint(0, max(1, len(base) // 40)))))
    chain = [f"c{i}" for i in range(200)]
    for k in range(12):  # each like the next, the ends unlike each other
        rows.append((len(rows) + 1, " ".join(chain[12 * k : 12 * k + 130])))
    for k in range(15):  # a passage that no two of them may link by, and one that all of some size may
        rows.append((len(rows) + 1, " ".join([*passage[:28], *(f"o{k}_{i}" for i in range(10))])))
        rows.append((len(rows) + 1, " ".join([*passage[::-1], *(f"n{k}_{i}" for i in range(k % 5))])))
    rnd.shuffle(rows)
    assert found(spark, rows, **bounds) == brute(rows)


def test_a_passage_below_the_threshold_makes_no_pairs(spark):
    passage = [f"p{i}" for i in range(90)]
    rows = [(k, " ".join([*passage, *(f"o{k}_{i}" for i in range(15))])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scanned = ngram_join._scan(df, 5, 1 << 12).cache()
    shared = ngram_join._shared(ngram_join._index(df, ngram_join._frequencies(scanned, 1 << 12), 5, 80))
    known = spark.createDataFrame([], "node long, label long")
    assert shared.select("node").distinct().count() == 60
    assert ngram_join._blocked(shared, known, 80, 8).isEmpty()
    assert {r.component_id for r in near_duplicates(df).collect()} == set(range(60))


def test_rows_that_repeat_an_id_meet_once(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(base)), (7, " ".join(base[:58])), (7, " ".join(base[:58])), (None, " ".join(base[3:])), (None, "a b"), (2, "a  b")]
    assert found(spark, rows * 3) == brute(rows * 3)


def test_odd_documents(spark):
    df = near_duplicates(odd.documents(spark))
    assert Counter(tuple(r) for r in df.collect()) == brute(odd.ROWS)
    assert near_duplicates(odd.documents(spark, [])).isEmpty()


def test_the_threshold_is_exact(spark):
    # 9 of 11 and 8 of 10 shingles in common, then 7 of 9.
    words_ = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words_[:14])), (2, " ".join(words_[1:14])), (3, " ".join(words_[:12])), (4, " ".join(words_[3:14]))]
    assert found(spark, rows) == brute(rows)


def test_shingle_sets_have_the_right_sizes_and_meet_rightly():
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["a", "B", "b", "É", "é", "x\x0by", "\x85"]) for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    texts += ["", " ", "\t\n", "one", "one two three four", "ONE two three four", "q " * 5000]
    sets, own = list(shingle_sets(pa.array(texts))), [plain_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in own]
    for i in range(0, len(texts), 7):
        for j in range(0, len(texts), 5):
            assert len(np.intersect1d(sets[i], sets[j])) == len(own[i] & own[j])
    assert [list(x) for x in shingle_sets(pa.array(texts).slice(5, 20))] == [list(x) for x in sets[5:25]]
    data, starts, ends, owner = words(pa.array(["ab c", "d"]))
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"ab", b"c", b"d"] and list(owner) == [0, 0, 1]


def test_filters_drop_no_similar_pair(spark):
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(400)]
    texts = [mutated(rnd, base[: rnd.randint(330, 400)], rnd.randint(0, 6)) for _ in range(25)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = ngram_join._index(df, np.zeros(64, dtype=np.uint32), 5, 80)
    a, b = (index.select(*(index[c].alias(f"{x}{c}") for c in index.columns)) for x in "ab")
    kept = a.join(b, a.atoken == b.btoken).where("anode < bnode").where(ngram_join._may_link("a", "b", 80))
    pairs = {tuple(r) for r in kept.select("anode", "bnode").distinct().collect()}
    from sunsieve.llm.shingles import signature

    node = [signature(s) for s in shingle_sets(pa.array(texts))]
    sets = [plain_set(t) for t in texts]
    similar = {
        tuple(sorted((node[i], node[j])))
        for i in range(25)
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and node[i] != node[j]
    }
    assert similar and similar <= pairs


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)] + [(7, 7)]
    name = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in name:
        for a, b in links:
            if a != b:
                name[a] = name[b] = min(name[a], name[b])
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = components(df).collect()
    assert len(got) == len(name) and {r.node: r.label for r in got} == name
