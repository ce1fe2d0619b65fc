"""Quality rules: how far a document's histograms lie from those of its language.

Two histograms of a document, of character classes in its words and of its language's most common
words, are compared with the same histograms over all documents of the language that pass the base
rules, by Jensen-Shannon distance. Short documents say too little and are not compared. Everything
is built-in columns; a document needs no other row but the few language references.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunsieve.llm.common import text_of

#: White space between words.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Common words of each language that has a reference.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "for", "was", "with"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se"],
}
N_COMMON = 10
#: Upper case, digits, symbols, other ASCII marks, all other characters.
N_CLASSES = 5


@dataclass(frozen=True)
class Limits:
    """From which sizes documents are compared, and the distances up to which they are kept."""

    least_chars: int = 200
    least_words: int = 100
    char_distance: float = 0.32
    word_distance: float = 0.25


def _settled(rows: DataFrame) -> DataFrame:
    """The same rows, their columns computed here and once.

    Else the optimizer may move the expression of a column into a filter or a lambda that mentions
    it, where it is computed anew for every mention or element.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _repeat_words(words: str, n_words: str) -> tuple[Column, Column]:
    """The hashes of three-word windows, and from them the words inside windows found twice or more."""
    at = F.sequence(F.lit(0), F.col(n_words) - 3)
    three = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3))))
    windows = F.when(F.col(n_words) >= 3, three).otherwise(F.array().cast("array<bigint>"))

    def again(item: Column, k: Column, items: Column) -> Column:
        same = [F.get(items, k + d)["h"] == item["h"] for d in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    return windows, again


def features(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """`carry` columns of the documents, as the struct `row`, and counts of each whole text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, the language's key
    `lang_key` (null without a reference), and the counts of character classes (char_counts) and of
    common words and all others (word_counts).
    A null text is empty. Two windows of words are the same if their 64-bit hashes are.
    """
    carry = docs.columns if carry is None else carry
    row = F.struct(*(F.col(f"`{c}`") for c in carry))
    lang = F.col("lang").cast("string")
    rows = docs.select(row.alias("row"), F.when(lang.isin(*COMMON_WORDS), lang).alias("lang_key"), text_of().alias("text"))
    bare = F.btrim("text", F.lit(SPACES))
    split = F.split(bare, r"[\x20\x09-\x0D]+")
    empty = F.array().cast("array<string>")
    rows = rows.select("*", F.when(bare == "", empty).otherwise(split).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.select(
        "row",
        "lang_key",
        "words",
        F.size("words").alias("n_words"),
        F.array_join("words", "").alias("joined"),
        lines.alias("lines"),
    )
    rows = _settled(rows)
    windows, again = _repeat_words("words", "n_words")
    spelt = [w for words in COMMON_WORDS.values() for w in words]
    spelt = sorted({*spelt, *(w.capitalize() for w in spelt)})
    rows = rows.select(
        "row",
        "lang_key",
        "n_words",
        "joined",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        windows.alias("windows"),
        F.transform(F.filter("words", lambda w: w.isin(*spelt)), F.lower).alias("common"),
    )
    rows = _settled(rows)

    def left(pattern: str) -> Column:
        return F.length("joined") - F.length(F.regexp_replace("joined", pattern, ""))

    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    own = reduce(
        lambda rest, x: F.when(F.col("lang_key") == x[0], F.array(*map(F.lit, x[1]))).otherwise(rest),
        COMMON_WORDS.items(),
        empty,
    )
    rows = rows.select(
        "row",
        "lang_key",
        "n_words",
        "n_dup_lines",
        F.length("joined").alias("word_chars"),
        (F.length("joined") - F.length(F.translate("joined", SYMBOLS, ""))).alias("n_symbols"),
        left(r"\p{Lu}").alias("n_upper"),
        left("[0-9]").alias("n_digits"),
        left("[!-/:-@\\[-`{-~]").alias("n_ascii_marks"),
        F.when(repeats, placed).alias("placed"),
        F.transform(own, lambda c: F.size(F.filter("common", lambda w: w == c))).alias("counts"),
    )
    rows = _settled(rows)
    found = F.filter("placed", lambda item, k: again(item, k, F.col("placed")))
    rows = rows.withColumn("places", F.sort_array(F.transform(found, lambda x: x["i"])))
    covered = F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0))
    marks, others = F.col("n_ascii_marks") - F.col("n_symbols"), F.col("word_chars") - F.col("n_upper") - F.col("n_digits")
    classes = F.array("n_upper", "n_digits", "n_symbols", marks, others - F.col("n_ascii_marks"))
    known = F.when(F.size("counts") > 0, F.col("counts")).otherwise(F.array_repeat(F.lit(0), N_COMMON))
    rest = F.col("n_words") - F.aggregate("known", F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("known", known).select(
        "row",
        "lang_key",
        *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")),
        total.cast("long").alias("n_repeat_words"),
        classes.cast("array<bigint>").alias("char_counts"),
        F.concat("known", F.array(rest)).cast("array<bigint>").alias("word_counts"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return _settled(rows.withColumn("base_failed", failed))


def references(counted: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Each language's share of every character class and common word, over all its documents.

    One row per language of COMMON_WORDS comes to the driver. Documents that fail the base rules
    are left out; a language without words has no reference.
    """
    sizes = {"char_counts": N_CLASSES, "word_counts": N_COMMON + 1}
    sums = [F.array(*(F.sum(F.get(c, F.lit(k))) for k in range(n))).alias(c) for c, n in sizes.items()]
    rows = counted.where("lang_key IS NOT NULL AND NOT base_failed").groupBy("lang_key").agg(*sums).collect()
    return {r.lang_key: {c: [x / sum(r[c]) for x in r[c]] for c in sizes} for r in rows}


def js_distance(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two distributions (arrays), to base 2: 0 if equal, 1 if disjoint."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(shares, reference, lambda p, q: part(p, q) + part(q, p))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2))


def judged(counted: DataFrame, known: dict[str, dict[str, list[float]]], limits: Limits = Limits()) -> DataFrame:
    """`features` with char_distance, word_distance (null where not compared) and kept."""

    def distance(counts: str, total: str, least: int) -> Column:
        if not known:
            return F.lit(None).cast("double")
        pairs = [(F.lit(lang), F.array(*map(F.lit, shares[counts]))) for lang, shares in known.items()]
        reference = F.create_map(*(x for pair in pairs for x in pair))[F.col("lang_key")]
        n = F.col(total)
        shares = F.transform(counts, lambda c: c / n)
        return F.when((n >= least) & F.col("lang_key").isin(*known), js_distance(shares, reference))

    compared = counted.select(
        "*",
        distance("char_counts", "word_chars", limits.least_chars).alias("char_distance"),
        distance("word_counts", "n_words", limits.least_words).alias("word_distance"),
    )
    near = F.coalesce(F.col("char_distance") <= limits.char_distance, F.lit(True))
    near &= F.coalesce(F.col("word_distance") <= limits.word_distance, F.lit(True))
    return compared.withColumn("kept", ~F.col("base_failed") & near)
