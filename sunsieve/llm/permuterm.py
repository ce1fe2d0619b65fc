"""Spelling variants by permuterm rotations.

A word with a terminator behind it has as many rotations as letters and terminator together. In one
of them any edited character stands last: two words that differ in that character alone share all
before it, and a word that lacks it has all before it as a whole rotation of its own. So every
rotation is written twice, whole and without its last character; sorted, equal prefixes lie in one
range. Words that share a prefix without their last characters are replacements of each other, and
the word whose whole rotation it is lacks one character of theirs.

A range holds at most one word per letter, and one that lacks it. It is scanned once, and tells each
of its words how many neighbours it has there and which is the most frequent; words never meet in
pairs.
"""

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, runs, text_of
from sunsieve.sources.shared import landed

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: What ends a word: no letter, and before all letters in order.
END = "$"
#: Code points of a word and occurrences, at least.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent as its variant.
FACTOR = 2
#: One in so many words of a document loses a character, see `words_of`.
DAMAGED = 97
#: Different words that a task holds before it hands on their counts.
HELD = 100_000


def words_of(doc_id: int | None, text: str, damaged: int = DAMAGED) -> Counter:
    """How often each word stands in the text: runs of letters, capitals of ASCII lowered.

    Where `damaged` divides the crc32 of `<doc_id>:<run>`, the run loses the code point at that
    number, counted round; with 0 none does. A null doc_id is written as nothing.
    """
    out: Counter = Counter()
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        raw = run.encode().lower()  # bytes lower ASCII alone
        word = raw.decode()
        if damaged and (h := crc32(raw, start)) % damaged == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def word_counts(docs: DataFrame, damaged: int = DAMAGED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of all whole texts that are long and frequent enough; a task counts before the shuffle."""

    def step(batches: Batches) -> Batches:
        held: Counter = Counter()

        def emit() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for run in runs(batch, "text"):
                for doc_id, text in zip(run.column("doc_id").to_pylist(), run.column("text").to_pylist()):
                    for word, n in words_of(doc_id, text, damaged).items():
                        if len(word) >= least_length:
                            held[word] += n
                    if len(held) >= HELD:
                        yield emit()
        yield emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    counted = rows.mapInArrow(step, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(prefix, whole, once): each rotation of the marked word whole, and without its last character.

    Leaving out either of two equal letters in a row gives the same word; `once` marks the first.
    """
    marked = word + END
    for k in range(len(marked)):
        rotated = marked[k:] + marked[:k]
        yield rotated, True, True
        last = (k - 1) % len(marked)
        if marked[last] != END:
            yield rotated[:-1], False, last == 0 or marked[last - 1] != marked[last]


def _rotated(words: DataFrame) -> DataFrame:
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                rows = []
                part = batch.slice(start, 2_000)
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    rows += [(prefix, whole, once, word, n) for prefix, whole, once in rotations(word)]
                kinds = [pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.int64()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "whole", "once", "word", "n"])

    return words.mapInArrow(step, "prefix string, whole boolean, once boolean, word string, n long")


def _better(a: tuple[str, int] | None, b: tuple[str, int] | None) -> tuple[str, int] | None:
    """The more frequent word; of equals the first in code-point order."""
    if a is None or b is None:
        return a or b
    return min(a, b, key=lambda x: (-x[1], x[0]))


def scan_range(rows: list[tuple[bool, bool, str, int]]) -> Iterator[tuple[str, int, tuple[str, int]]]:
    """(word, neighbours in the range, the best of them) for each row (whole, once, word, n) that has some."""
    lacking = [(w, n) for whole, _, w, n in rows if whole]
    holes = sorted(((w, n) for whole, _, w, n in rows if not whole), key=lambda x: (-x[1], x[0]))
    lacks = lacking[0] if lacking else None
    longer = []
    for whole, once, word, n in rows:
        if whole:
            continue
        best = holes[0] if holes[0][0] != word else holes[1] if len(holes) > 1 else None
        near = len(holes) - 1
        if once and lacks:
            longer.append((word, n))
            near, best = near + 1, _better(best, lacks)
        if near:
            yield word, near, best
    if longer:
        yield lacks[0], len(longer), min(longer, key=lambda x: (-x[1], x[0]))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): how many words are one edit away, and the most frequent of them.

    `words` holds distinct words with their number n. Words without neighbours have no row.
    """

    def step(batches: Batches) -> Batches:
        names = ["word", "n_near", "near", "near_n"]
        prefix, held = None, []  # a range may go on in the next batch
        for batch in batches:
            out = []
            for p, *row in zip(*(batch.column(c).to_pylist() for c in ("prefix", "whole", "once", "word", "n"))):
                if p != prefix:
                    if len(held) > 1:
                        out += scan_range(held)
                    prefix, held = p, []
                held.append(tuple(row))
            yield _neighbour_rows(out, names)
        yield _neighbour_rows(list(scan_range(held)) if len(held) > 1 else [], names)

    ranges = _rotated(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "whole", "word")
    found = ranges.mapInArrow(step, "word string, n_near long, near string, near_n long")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.near", "best.near_n")


def _neighbour_rows(found: list, names: list[str]) -> pa.RecordBatch:
    columns = [[x[0] for x in found], [x[1] for x in found], [x[2][0] for x in found], [x[2][1] for x in found]]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each (word, form): where following forms ends.

    Forms grow more frequent at every step, so that there is no way round; each round doubles the
    steps that all words have followed, and is written to the shared folder.
    """
    known = landed(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not known.where("moved").isEmpty():
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        further = known.join(ahead, "root", "left")
        known = landed(
            further.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "forms"
        )
    return known.select("word", "root")


def spelling_groups(
    docs: DataFrame,
    damaged: int = DAMAGED,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the documents.

    Words are runs of letters of the whole texts (see `words_of`) of at least `least_length` code
    points that occur `least_count` times or more in all. `n_near` words are one inserted, deleted
    or replaced code point away; the most frequent of them (ties: the first in code-point order) is
    the word's `form` if it is at least `factor` times as frequent; `root` is where following forms
    ends, the word itself if it has none.

    A null text has no words, repeated rows count again, documents of a null doc_id are damaged as
    if it were empty, an empty table gives no rows, and other columns are not read.
    """
    words = landed(word_counts(docs, damaged, least_length, least_count), "words")
    near = landed(neighbours(words), "near")
    full = words.join(near, "word", "left")
    is_form = F.col("near_n") >= factor * F.col("n")
    full = full.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    full = landed(full, "spelled")
    found = roots(full.where("form IS NOT NULL"))
    return full.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
