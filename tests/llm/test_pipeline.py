import random
from collections import Counter, defaultdict

import odd
import pytest
from pyspark.sql import functions as F
from test_duplicates import brute
from test_rules import made_documents, plain_counts
from tokenizers import Tokenizer

import corpus_pipeline
from sunsieve.llm import ngram_join
from sunsieve.llm.divergence import features, judged, references
from sunsieve.llm.secret_scan import labelled_runs, redact, scan, train
from sunsieve.llm.tokenizer import packed, vocabulary
from sunsieve.sources import shared
from sunsieve.sources.shared import landed

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(9)
    rows = made_documents(40)
    for k in range(12):  # copies, near copies, and secrets
        base = rows[rnd.randrange(40)]
        text = base[1] if k % 2 else base[1] + " and one more"
        rows.append((100 + k, text + (f"\ntoken = '{rnd.random()}abcdef'" if k % 3 == 0 else ""), base[2]))
    return landed(odd.documents(spark, rows + odd.ROWS), "documents")


def rows_of(df):
    return [(r.doc_id, r.text, r.lang) for r in df.collect()]


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "secret scans", "packing"]


def test_stages_do_what_plain_python_does(spark, docs):
    one = landed(STAGES["quality rules"](spark, docs, ""), "one")
    assert one.columns == docs.columns
    counted = features(docs)
    verdicts = judged(counted, references(counted)).select("row.doc_id", "row.text", "kept", "base_failed").collect()
    assert Counter((r.doc_id, r.text) for r in verdicts if r.kept) == Counter((d, t) for d, t, _ in rows_of(one))
    assert all(r.base_failed == plain_counts(r.text or "")[-1] for r in verdicts)

    two = landed(STAGES["n-gram Jaccard join"](spark, one, ""), "two")
    assert two.columns == docs.columns
    before, after = rows_of(one), rows_of(two)
    numbered = [(k, t) for k, (_, t, _) in enumerate(before)]
    groups = defaultdict(list)
    for (k, _, label), n in brute(numbered).items():
        groups[label] += [before[k]] * n
    assert len(after) == len(groups) < len(before)
    stays = Counter(min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values())
    assert Counter(d for d, _, _ in after) == stays

    three = landed(STAGES["secret scans"](spark, two, ""), "three")
    models = train(labelled_runs(two))
    want = Counter((d, redact(t, scan(t, models)) if t else t) for d, t, _ in after)
    assert three.columns == docs.columns and Counter((d, t) for d, t, _ in rows_of(three)) == want
    assert three.where(F.col("n_chars") != F.length("text")).isEmpty()
    assert three.where("text LIKE '%[assign]%'").count() > 0 and two.where("text LIKE '%[assign]%'").isEmpty()

    own = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    parts = defaultdict(list)
    for r in STAGES["packing"](spark, three, "").collect():
        parts[r.doc_id].append((r.start, bytes(r.ids)))
    got = {d: b"".join(x for _, x in sorted(p)) for d, p in parts.items()}
    assert got == {d: packed([*own.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, _ in rows_of(three)}


def test_repeated_and_missing_ids_leave_one_of_each_group(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "en"), (1, words, "en"), (None, words, "en"), (None, words + " x", "en"), (1, "quite another text", "en")]
    rows += [(None, "a third text of its own", "en"), (2, "", "en"), (2, "", "en"), (None, None, "en")]
    found = corpus_pipeline.near_duplicate_groups(spark, landed(odd.documents(spark, rows), "documents"), "")
    want = [(1, words), (1, "quite another text"), (None, "a third text of its own"), (2, ""), (2, ""), (None, None)]
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter(want)


def test_no_documents(spark):
    none = landed(odd.documents(spark, []), "documents")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").isEmpty(), name


def test_no_text_is_lost_when_files_are_cut_otherwise_between_passes(spark, monkeypatch, tmp_path):
    texts = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(600)]
    rows = [(k, texts[k % 600], "en") for k in range(1200)]
    odd.documents(spark, rows).repartition(9).write.parquet(str(tmp_path / "docs"))
    turns = iter(range(10**6))

    def cut_otherwise(df, name, keep=False):
        found = landed(df, name, keep)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", [1, 16, 3, 7][next(turns) % 4])
        return found

    for module in (corpus_pipeline, ngram_join):
        monkeypatch.setattr(module, "landed", cut_otherwise)
    try:
        found = corpus_pipeline.near_duplicate_groups(spark, spark.read.parquet(str(tmp_path / "docs")), "")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 11)
        left = Counter(r.text for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert left == Counter(texts)


def test_run_leaves_only_what_the_last_stage_reads(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(shared, "shared_folder", lambda spark, name: str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}-x"))
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0
    left = {p.name.rsplit("-", 2)[0] for p in tmp_path.iterdir()}
    assert "secret-scans" in left and not left & {"quality-rules", "n-gram-Jaccard-join", "placed", "goes", "shingled", "shared"}
