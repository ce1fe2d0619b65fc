import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest
from hypothesis import given
from hypothesis import strategies as st

from odd import documents
from sunsieve.llm import permuterm, queries
from sunsieve.llm.permuterm import END, rotations, scan_range, spelling_groups, words_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, least_length=5, least_count=3, damaged=97):
    """Counts, neighbours, forms and roots by comparing all words with all."""
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damaged and h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def found(df, **more):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_groups(df, **more).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@given(st.sets(st.text("abé", min_size=1, max_size=6), min_size=2, max_size=25))
def test_ranges_meet_each_pair_once(words):
    by = {}
    for w in words:
        for prefix, whole, once in rotations(w):
            by.setdefault(prefix, []).append((whole, once, w, len(w)))
    count = Counter()
    for rows in by.values():
        for word, near, _ in scan_range(rows):
            count[word] += near
    assert count == +Counter({w: sum(one_edit(w, x) for x in words if x != w) for w in words})
    assert all(END not in w for w in words)


@pytest.mark.parametrize("held", [100_000, 3])
def test_equals_comparing_all_words(spark, monkeypatch, held):
    monkeypatch.setattr(permuterm, "HELD", held)
    text = "house house house house houses House mouse mouse mouse horse hause hausé hausÉ book boook bok booook " * 3
    docs = [(k, text + " ".join(f"wor{chr(97 + k % 26)}d wörd{'x' * (k % 4)}" for _ in range(1 + k % 5))) for k in range(60)]
    docs += [(k, "aaaaa aaaaaa aaaaaaa aaaaaab baaaaa abaaaa AAAAA") for k in range(60, 75)]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, word string, n string").repartition(4)
    assert found(df) == plain(docs)
    assert found(df, least_length=1, least_count=1, damaged=5) == plain(docs, 1, 1, 5)


def test_forms_are_followed_to_the_end(spark):
    # Each twice as frequent as the one before, one letter longer.
    text = " ".join(" ".join(["abcdefghijklmnop"[: 5 + k]] * (3 * 2**k)) for k in range(9))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling_groups(df, damaged=0).collect()}
    assert len(got) == 9 and {root for _, root in got.values()} == {"abcdefghijklm"} and got["abcde"][0] == "abcdef"


def test_ties_go_to_the_first_in_code_points(spark):
    text = "zebra " * 3 + "zebrb " * 6 + "zebré " * 6 + "zebr " * 6
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: r for r in spelling_groups(df, damaged=0, least_length=4).collect()}
    assert (got["zebra"].form, got["zebra"].form_n, got["zebra"].n_near) == ("zebr", 6, 3)
    assert got["zebrb"].form is None and got["zebrb"].root == "zebrb"


def test_odd_documents(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == plain(rows) and found(docs, least_count=1, least_length=1) == plain(rows, 1, 1)
    assert spelling_groups(docs.limit(0)).isEmpty()
    assert words_of(None, "") == Counter()


def test_query_against_comparing_all_words(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op13_permuterm_spellings(spark, sf)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain(docs)
