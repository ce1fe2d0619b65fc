import hashlib
import math
import random
import re
import string
from collections import Counter, defaultdict

import odd
import pytest
from pyspark.sql import functions as F

from sunsieve.llm import divergence, perspectives, queries, secret_scan
from sunsieve.llm.secret_scan import find_secrets, labelled_runs, scan, spelled, train, train_on

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    w = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(text.count(x) for x in "#*$%&|<>")
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed


def plain_shares(text, lang):
    w = re.findall(WORD, text)
    own = divergence.COMMON_WORDS[lang]
    known = {x for v in divergence.COMMON_WORDS.values() for x in v}
    known |= {x.capitalize() for x in known}
    words = [sum(x in known and x.lower() == c for x in w) for c in own]
    joined = "".join(w)
    upper, digits = sum(c.isupper() for c in joined), sum(c in string.digits for c in joined)
    symbols = sum(c in "#*$%&|<>" for c in joined)
    marks = sum(c in string.punctuation for c in joined) - symbols
    return [upper, digits, symbols, marks, len(joined) - upper - digits - symbols - marks], [*words, len(w) - sum(words)]


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    return math.sqrt(sum(x * math.log2(2 * x / (x + y)) / 2 for a, b in ((p, q), (q, p)) for x, y in zip(a, b) if x > 0))


def made_documents(n=60):
    rnd = random.Random(3)
    out = []
    for k in range(n):
        lang = rnd.choice(["en", "fr"])
        own = divergence.COMMON_WORDS[lang]
        tail = rnd.choice(["", "###", "!!", "12"]) if k % 4 == 0 else ""
        w = [rnd.choice(own) if rnd.random() < 0.3 else "".join(rnd.choices("abcdeé", k=5)) + tail for _ in range(rnd.randint(30, 300))]
        if k % 5 == 0:
            w = w[:40] * 3
        out.append((k, "\n".join(" ".join(w[i : i + 20]) for i in range(0, len(w), 20)), lang))
    return out


def test_counts_and_distances_are_those_of_plain_python(spark):
    rows = made_documents()
    counted = divergence.features(odd.documents(spark, rows)).cache()
    known = divergence.references(counted)
    sums = defaultdict(lambda: ([0] * 5, [0] * 11))
    for _, text, lang in rows:
        if not plain_counts(text)[-1]:
            sums[lang] = tuple([a + b for a, b in zip(x, y)] for x, y in zip(sums[lang], plain_shares(text, lang)))
    found = {r.row.doc_id: r for r in divergence.judged(counted, known).collect()}
    limits = divergence.Limits()
    for doc, text, lang in rows:
        r, want = found[doc], plain_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        for got, size, least, own, ref in zip(
            (r.char_distance, r.word_distance), (want[1], want[0]), (limits.least_chars, limits.least_words), plain_shares(text, lang), sums[lang]
        ):
            assert (got is None) == (size < least)
            if got is not None:
                assert got == pytest.approx(js(own, ref), abs=1e-9)
        far = (r.char_distance or 0) > limits.char_distance or (r.word_distance or 0) > limits.word_distance
        assert r.kept == (not want[-1] and not far)
    assert {r.kept for r in found.values()} == {True, False}


def test_quality_of_odd_documents(spark):
    counted = divergence.features(odd.documents(spark))
    found = divergence.judged(counted, divergence.references(counted)).collect()
    assert len(found) == len(odd.ROWS)
    want = Counter((d, *plain_counts(t or "")) for d, t, _ in odd.ROWS)
    assert Counter((r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == want
    empty = divergence.features(odd.documents(spark, []))
    assert divergence.references(empty) == {} and divergence.judged(empty, {}).isEmpty()
    plan = divergence.judged(counted, {})._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_base_spans():
    def found(text):
        return [(x.kind, x.start, x.end) for x in secret_scan.base_spans(text)]

    assert found("my Token = \"abc.def1\" x") == [("assign", 3, 20)]
    assert found("token:token:abcdefgh") == []  # the first match takes the second keyword, and is too short
    assert found("paſsword=abcdefgh") == []  # a long s is no s
    assert found("é AKIA" + "A1" * 8) == [("access", 2, 22)] and found("AKIA" + "A" * 15) == []
    assert found("g" + "0a" * 12 + "G") == [("hex", 1, 25)] and found("0a" * 11 + "0") == []
    assert found("api_key='" + "ab12" * 6 + "'") == [("assign", 0, 33), ("hex", 9, 33)]
    assert found("password: secret=hunter22") == [("assign", 0, 25)]


def models(spark):
    rnd = random.Random(1)
    plain = ["get", "user", "name", "list", "count", "value", "table", "index", "order", "state", "event", "frame"]
    ordinary = ["_".join(rnd.choices(plain, k=rnd.randint(2, 4))) + rnd.choice(["", "2", "_v1"]) for _ in range(3000)]
    secret = ["".join(rnd.choices(string.ascii_letters + string.digits, k=rnd.randint(20, 40))) for _ in range(3000)]
    rows = [(True, x) for x in secret[:2000]] + [(False, x) for x in ordinary[:2000]] + [(None, "x"), (True, None), (False, "")]
    return train(spark.createDataFrame(rows, "random boolean, run string")), secret[2000:], ordinary[2000:]


def test_the_models_tell_held_out_samples_apart(spark):
    fitted, secret, ordinary = models(spark)
    assert sum(fitted.score(x) > fitted.log_odds for x in secret) > 0.99 * len(secret)
    assert sum(fitted.score(x) > fitted.log_odds for x in ordinary) < 0.01 * len(ordinary)
    text = f"see {secret[0]}1a, {ordinary[0]}_2b_{ordinary[1]} and token={'q' * 8}"
    spans = scan(text, fitted)
    assert [s[0] for s in spans] == ["markov", "assign"] and spans[0][1:3] == (4, 6 + len(secret[0]))
    assert secret_scan.redact(text, spans) == f"see [markov], {ordinary[0]}_2b_{ordinary[1]} and [assign]"


IDENTIFIERS = """get_user_name_v1 covid-19-vaccine-2021 chapter-10-section-12 ORDER-2023-0001234 ISBN9783161484100
20240115T093000Z 2024-01-15T09-30-00 getUserNameByNumber2 /2021/03/14/how-to-bake-bread release-notes-v2-10-3""".split()


def test_models_of_a_corpus_leave_dates_and_versions_and_find_random_strings(spark):
    rnd = random.Random(5)
    common = "the weather of this summer was quite warm and letters about gardens arrived after another".split()
    secret = ["".join(rnd.choices(string.ascii_letters + string.digits, k=32)) for _ in range(40)]
    rows = []
    for k in range(400):
        w = rnd.choices(common, k=60)
        if k % 10 == 0:
            w += [f"password={secret[k // 10]}", "see", "".join(rnd.choices(string.ascii_letters + string.digits, k=32))]
        elif k % 10 < 4:
            w += [f"2023-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)}", IDENTIFIERS[k // 10 % len(IDENTIFIERS)], f"chapter-{k}"]
        rows.append((k, " ".join(w), "en"))
    docs = odd.documents(spark, rows)
    found = find_secrets(docs, train(labelled_runs(docs))).select("doc_id", "secrets.kind").collect()
    assert {r.doc_id: r.kind for r in found if r.kind} == {k: ["assign", "markov"] for k in range(0, 400, 10)}
    fitted = train(labelled_runs(docs))
    assert [x for x in IDENTIFIERS if fitted.score(x) > fitted.log_odds] == []
    assert not any(secret_scan.words_and_numbers(x) for x in secret)


def test_copies_of_a_document_leave_the_models_unchanged(spark):
    rows = [(k, f"page {k} of chapter-{k} says password={k:08x}ab", "en") for k in range(30)]
    once, again = (odd.documents(spark, x) for x in (rows, rows + rows[:1] * 40 + [(99, None, "en"), (100, "", "en")]))
    for documents in (10, 5_000):
        samples = [Counter(map(tuple, labelled_runs(x, documents).collect())) for x in (once, again)]
        if documents > 30:
            assert samples[0] == samples[1] and len(samples[0]) == 60
            assert (train(labelled_runs(once)).ratio == train(labelled_runs(again)).ratio).all()
        assert all(sum(n for (random, _), n in x.items() if random) <= documents for x in samples)


def test_untrained_models_find_base_spans_only(spark):
    empty = train(spark.createDataFrame([], "random boolean, run string"))
    assert [s[0] for s in scan("x " + "aB3" * 10 + " " + "0a" * 12, empty)] == ["hex"]


def test_secrets_of_odd_documents(spark):
    rows = [*odd.ROWS, (20, "x " * 70_000 + "token = '0123456789abcdef0123456789'", "en")]
    docs = odd.documents(spark, rows)
    found = find_secrets(docs, train(labelled_runs(docs)))
    assert found.columns == [c for c in docs.columns if c != "secrets"] + ["secrets", "redacted"]
    got = found.select("doc_id", "text", "redacted", spelled(F.col("secrets")).alias("s")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((d, t) for d, t, _ in rows)
    assert {r.doc_id: r.s for r in got if r.s} == {20: "assign:140000:140035,hex:140009:140035"}
    assert all(r.redacted == r.text for r in got if not r.s)
    none = odd.documents(spark, [])
    assert find_secrets(none, train(labelled_runs(none))).isEmpty()


def python_inputs(df):
    """What each Python step of the plan gets, as a schema."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
        if node.nodeName() == "MapInArrow":
            found.append(node.child().schema().simpleString())
    return found


def test_a_text_goes_to_python_once(spark):
    docs = odd.documents(spark)
    found = find_secrets(docs, train(spark.createDataFrame([], "random boolean, run string")))
    (given,) = python_inputs(found)
    assert given.count("text:") == 1 and "lang:" in given


def test_one_python_step_labels_and_counts(spark, monkeypatch):
    seen = []
    fitted = secret_scan._fitted
    monkeypatch.setattr(secret_scan, "_fitted", lambda counted, odds: seen.append(len(python_inputs(counted))) or fitted(counted, odds))
    docs = odd.documents(spark, [*odd.ROWS, *((k, f"page {k} of chapter-{k} says password={k:08x}ab", "en") for k in range(20, 50))])
    for documents in (10, 5_000):
        want = train(labelled_runs(docs, documents)).ratio
        assert (train_on(docs, documents).ratio == want).all() and want.any()
    assert seen == [2, 1, 2, 1]
    none = odd.documents(spark, [])
    assert (train_on(none).ratio == train(labelled_runs(none)).ratio).all()


def test_secrets_of_tables_with_texts_alone_or_of_another_type(spark):
    rows = [(1, "say token=abcdefgh", "en"), (2, None, "en"), (3, "", "en"), (4, "plain", "en")]
    docs = odd.documents(spark, rows)
    models = train(spark.createDataFrame([], "random boolean, run string"))
    want = Counter((t, "say [assign]" if t and "token" in t else t) for _, t, _ in rows)
    alone = find_secrets(docs.select("text"), models)
    assert alone.columns == ["text", "secrets", "redacted"] and Counter((r.text, r.redacted) for r in alone.collect()) == want
    coded = find_secrets(docs.withColumn("text", F.col("text").cast("binary")), models)
    assert dict(coded.dtypes)["text"] == "binary"
    assert Counter((None if r.text is None else bytes(r.text).decode(), r.redacted) for r in coded.collect()) == want


def plain_rotation(rows):
    out, groups = [], defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn if turn is not None else -(10**9), role if role and role.strip() else "unknown", text or "", turn))
    for conv, turns in groups.items():
        for who in {s for _, s, _, _ in turns} - {"system"}:
            at = 0
            for _, speaker, text, turn in sorted(turns, key=lambda x: x[:3]):
                role = "assistant" if speaker == who else "system" if speaker == "system" else "user"
                head = f"<|im_start|>{role}" + (f" name={speaker}" if role == "user" else "") + "\n"
                segment = head + text + "<|im_end|>\n"
                end = at + len(segment)
                mask = (at + len(head), end - 1) if role == "assistant" else (end, end)
                out.append((conv, who, turn, speaker, role, segment, at, end, *mask))
                at = end
    return Counter(out)


def test_every_participant_is_the_assistant_once(spark):
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(["anna", "bo", "cy", "system", None, " "]), rnd.choice(["hi", "é🙂", "", None])) for c in (1, 2, None) for t in range(30)]
    rows += [(3, None, "anna", "x"), (3, None, "bo", "y"), (3, 1, "anna", "z"), (3, 1, "anna", "z"), (4, 0, "system", "alone")]
    rows += [(5, t, "ab"[t % 2], f"turn {t}") for t in range(2 * perspectives.SPAN + 9)]
    # Without numbers and without a name, or all of one number: no span by turns would part these.
    rows += [(None, None, rnd.choice("ab"), f"x{rnd.randint(0, 40)}") for _ in range(2 * perspectives.SPAN)]
    rows += [(6, 7, "a", "same") for _ in range(perspectives.SPAN + 3)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, speaker int")
    found = perspectives.rotate(df)
    assert Counter(tuple(r) for r in found.collect()) == plain_rotation(rows)
    assert perspectives.rotate(df.limit(0)).isEmpty()
    one = found.where("conv_id = 5 AND perspective = 'a'").orderBy("start").collect()
    text = "".join(r.segment for r in one)
    trained = [text[r.mask_start : r.mask_end] for r in one if r.mask_end > r.mask_start]
    assert trained == [f"turn {t}<|im_end|>" for t in range(0, 2 * perspectives.SPAN + 9, 2)]
    assert "Python" not in found._jdf.queryExecution().optimizedPlan().toString()


CONTRACT = {
    "assign": re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def contract_spans(text):
    """Base spans as the contract words them."""
    least = {"assign": 6, "access": 20, "hex": 24}
    found = []
    for place, (kind, pattern) in enumerate(CONTRACT.items()):
        for m in pattern.finditer(text):
            value = m[2] if kind == "assign" else m[0]
            if len(value) >= least[kind]:
                found.append((m.start(), place, kind, m.end(), value))
    return sorted(found)


def kind_of(c):
    return "A" if c in string.ascii_uppercase else "a" if c in string.ascii_lowercase else "0" if c.isdigit() else "+" if c in "+/_=-" else "^"


class PlainModel:
    """A character model in dictionaries: kind of the next character by the run's sort, then the character itself."""

    def __init__(self, samples):
        self.kinds, self.pairs = Counter(), Counter()
        for run in samples:
            sort = bool(re.search("[0-9]", run))
            for a, b in zip("^" + run, run):
                self.kinds[sort, kind_of(a), kind_of(b)] += 1
                self.pairs[a, b] += 1

    def log(self, run):
        sort, out = bool(re.search("[0-9]", run)), 0.0
        for a, b in zip("^" + run, run):
            row = sum(self.kinds[sort, kind_of(a), k] for k in "Aa0+^")
            kind = self.kinds[sort, kind_of(a), kind_of(b)] + secret_scan.RARE * row + 1
            same = [c for c in secret_scan.ALPHABET if kind_of(c) == kind_of(b)]
            inside = (self.pairs[a, b] + 1) / sum(self.pairs[a, c] + 1 for c in same)
            out += math.log(kind / (row + 5 * secret_scan.RARE * row + 5)) + math.log(inside)
        return out


def test_query_is_what_plain_python_finds(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    random_, ordinary = [], []
    for text in {t for _, t in docs}:
        taken = contract_spans(text)
        random_ += [x[4] for x in taken]
        for m in re.finditer("[A-Za-z0-9+/_=-]{5,}", text):
            if all(m.end() <= x[0] or x[3] <= m.start() for x in taken) and secret_scan.words_and_numbers(m[0]):
                ordinary.append(m[0])
    # Dots of values are no known characters: a start.
    random_ = [x.replace(".", "^") for x in random_]
    one, other = PlainModel(random_), PlainModel(ordinary)
    want = Counter()
    for doc_id, text in docs:
        base = contract_spans(text)
        spans = [x[:4] for x in base]
        for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text):
            free = all(m.end() <= x[0] or x[3] <= m.start() for x in base)
            if free and re.search("[A-Za-z0-9]", m[0]) and one.log(m[0]) - other.log(m[0]) > math.log(1000):
                spans.append((m.start(), 3, "markov", m.end()))
        spelt = [",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(x)) for x in ([x[:4] for x in base], spans)]
        counts = tuple(sum(x[2] == k for x in base) for k in CONTRACT)
        want[(doc_id, *counts, hashlib.sha256(spelt[0].encode()).hexdigest(), spelt[1])] += 1
    found = queries.op4_markov_secrets(spark, sf)
    found = found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert Counter(map(tuple, found.collect())) == want


def test_the_ratio_decides_on_runs_of_letters_too(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choice(x) for x in ("bdgklmnprst", "aeiou") * rnd.randint(2, 4)) for _ in range(300)]
    text = " ".join(rnd.choice(words) for _ in range(3000)) + " ".join(f" token={''.join(rnd.choices(string.ascii_letters + string.digits, k=32))}" for _ in range(60))
    models = train(labelled_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    letters = ["".join(rnd.choices(string.ascii_letters, k=32)) for _ in range(100)]
    assert sum(len(scan(x, models)) for x in letters) >= 80  # no sample of letters alone is random here
    assert sum(len(scan("".join(rnd.choices(words, k=5)), models)) for _ in range(200)) == 0
    assert scan("-" * 40 + " " + "=" * 30 + " " + "_" * 16, models) == []
