"""Secrets in texts: fixed patterns, and character Markov models for what no pattern names.

Two models of character pairs, one of random strings and one of ordinary identifiers, score each
run of 16 identifier characters and more; the log-likelihood ratio decides. They are trained from
labelled samples: what the patterns find in the corpus is random; words, numbers and the runs made of
them are ordinary. Which kind of character follows which is learnt apart from samples with and without
digits, and a run is scored by its own sort: next to the many words without one, any digit would look
random.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sunsieve.llm.common import Batches, runs, text_of

# The patterns of the base rules and what a match needs to stay.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 24 and more are the whole runs that a shorter minimum would find.
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "markov")

#: Runs that the models score, and the characters they know; any other character is one more.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_PLACE = np.full(128, len(ALPHABET), dtype=np.int64)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_STATES = len(ALPHABET) + 1
#: Kinds of characters: capitals, small letters, digits, marks and the rest, which is also the start.
_CLASS = np.repeat(np.arange(5), (26, 26, 10, 5, 1))

#: Candidates for ordinary samples, and the words and numbers that they are made of.
CANDIDATE, DIGIT = re.compile(r"[A-Za-z0-9+/_=-]{5,}"), re.compile(r"[0-9]")
PART, PIECE = re.compile(r"[A-Za-z0-9]+"), re.compile(r"[0-9]+|[A-Z]?[a-z]+|[A-Z]+")
LEAST_PIECE = 3

#: Documents whose runs train the models: those with the smallest hashes of the text.
TRAINING_DOCUMENTS = 5_000
#: The share at least with which any kind of character follows another.
RARE = 0.02
#: How much likelier random must be: a run is rarely a secret.
LOG_ODDS = float(np.log(1000))

SPAN = "struct<kind:string,start:int,end:int,score:double>"


@dataclass(frozen=True)
class Span:
    """Code points start..end of a text; `value` is the secret inside."""

    kind: str
    start: int
    end: int
    value: str


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each pattern, by kind; those too short are dropped."""
    out = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                out.append(Span("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        out += [Span("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return out + [Span("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]


def other_runs(text: str, taken: list[Span]) -> list[Span]:
    """Long runs of identifier characters, not of marks alone, that no base span touches."""
    found = [Span("markov", m.start(), m.end(), m[0]) for m in RUN.finditer(text) if PART.search(m[0])]
    return [x for x in found if all(x.end <= t.start or t.end <= x.start for t in taken)]


def words_and_numbers(run: str) -> bool:
    """Whether each part between marks is a word, a number or both, or changes between them seldom."""
    for part in PART.findall(run):
        n = len(PIECE.findall(part))
        if n > 2 and len(part) < LEAST_PIECE * n:
            return False
    return True


def ordinary_samples(text: str, taken: list[Span]) -> list[str]:
    """Words, numbers and runs of both that no base span touches; a run that looks random gives none."""
    found = (m for m in CANDIDATE.finditer(text) if all(m.end() <= t.start or t.end <= m.start() for t in taken))
    return [m[0] for m in found if words_and_numbers(m[0])]


def pairs(run: str) -> np.ndarray:
    """The run's character pairs as numbers, the first after a start state of its own."""
    codes = np.frombuffer(run.encode("ascii", "replace"), dtype=np.uint8)
    at = _PLACE[np.minimum(codes, 127)]
    return np.concatenate(([len(ALPHABET)], at[:-1])) * _STATES + at


@dataclass(frozen=True)
class Models:
    """log P(random) - log P(ordinary) of each character pair, of runs without and of runs with digits."""

    ratio: np.ndarray
    log_odds: float = LOG_ODDS

    def score(self, run: str) -> float:
        return float(self.ratio[1 if DIGIT.search(run) else 0, pairs(run)].sum())


def fit(random: np.ndarray, ordinary: np.ndarray, log_odds: float = LOG_ODDS) -> Models:
    """Models from counts of character pairs in labelled samples: of those without and of those with digits.

    P(next) is P(its kind), from the samples of one sort, times P(next, given its kind), from all;
    each is smoothed as if seen once more than it was, and no kind is rarer behind another than
    `RARE`, as the corpus may lack what is ordinary elsewhere. Without samples a model is uniform in both
    steps, so that two untrained models find nothing.
    """
    of_kind = np.eye(5)[_CLASS]

    def logs(counts: np.ndarray) -> np.ndarray:
        pair = counts.reshape(2, _STATES, _STATES)
        smooth = pair.sum(axis=0) + 1.0
        inside = np.log(smooth / (smooth @ of_kind)[:, _CLASS])
        kinds = of_kind.T @ pair @ of_kind
        kinds = kinds + RARE * kinds.sum(axis=2, keepdims=True) + 1.0
        kinds = np.log(kinds / kinds.sum(axis=2, keepdims=True))
        return (kinds[:, _CLASS][:, :, _CLASS] + inside).reshape(2, -1)

    return Models(logs(random) - logs(ordinary), log_odds)


def _training_texts(docs: DataFrame, documents: int) -> DataFrame:
    """A bounded sample of texts, equal ones taken once: those with the smallest hashes."""
    # At or below the cut are few texts, in any number of copies: one row of each hash stays.
    hashed = docs.select(text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    sample = hashed.select("h").distinct().orderBy("h").limit(documents)
    least = sample.agg(F.max("h").alias("most")).first().most
    few = hashed.where(F.col("h") <= F.lit(least)) if least is not None else hashed.limit(0)
    return few.groupBy("h").agg(F.min("text").alias("text")).select("text")


def _label(batches: Batches) -> Batches:
    for batch in batches:
        for run in runs(batch, "text"):
            labels, values = [], []
            for text in run.column("text").to_pylist():
                taken = base_spans(text)
                values += [x.value for x in taken]
                labels += [True] * len(taken)
                plain = ordinary_samples(text, taken)
                values += plain
                labels += [False] * len(plain)
            columns = [pa.array(labels, pa.bool_()), pa.array(values, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["random", "run"])


def _count(batches: Batches) -> Batches:
    counts = np.zeros((4, _STATES * _STATES), dtype=np.int64)
    for batch in batches:
        digits = pc.match_substring_regex(batch.column("run"), "[0-9]")
        for label, digit in ((False, False), (False, True), (True, False), (True, True)):
            own = pc.and_(pc.equal(batch.column("random"), label), pc.equal(digits, digit))
            joined = "\n".join(x for x in batch.column("run").filter(pc.fill_null(own, False)).to_pylist() if x)
            codes = np.frombuffer(joined.encode("ascii", "replace"), dtype=np.uint8)
            at = _PLACE[np.minimum(codes, 127)]  # the line end is no known character: a start state
            seen = np.concatenate(([len(ALPHABET)], at[:-1])) * _STATES + at
            counts[2 * label + digit] += np.bincount(seen[codes != 10], minlength=_STATES * _STATES)
    of, pair = np.nonzero(counts)
    columns = [pa.array(of), pa.array(pair), pa.array(counts[of, pair])]
    yield pa.RecordBatch.from_arrays(columns, names=["of", "pair", "n"])


_COUNTED = "of long, pair long, n long"


def _fitted(counted: DataFrame, log_odds: float) -> Models:
    counts = np.zeros((4, _STATES * _STATES))
    for row in counted.groupBy("of", "pair").agg(F.sum("n").alias("n")).collect():
        counts[row.of, row.pair] = row.n
    return fit(counts[2:], counts[:2], log_odds)


def labelled_runs(docs: DataFrame, documents: int = TRAINING_DOCUMENTS) -> DataFrame:
    """(random, run): labelled samples from a bounded sample of documents, equal texts taken once.

    Values of base spans are random. Ordinary are words, numbers and runs made of both, of five
    characters and more, that no base span touches; a run that looks random has no label.
    """
    return _training_texts(docs, documents).mapInArrow(_label, "random boolean, run string")


def train(samples: DataFrame, log_odds: float = LOG_ODDS) -> Models:
    """Fit the models to labelled samples (random, run); only counts of character pairs are gathered."""
    return _fitted(samples.select("random", "run").mapInArrow(_count, _COUNTED), log_odds)


def train_on(docs: DataFrame, documents: int = TRAINING_DOCUMENTS, log_odds: float = LOG_ODDS) -> Models:
    """`train(labelled_runs(docs))`, with samples labelled and counted by one Python worker a task.

    Two steps in Python after one another take two workers a task, and Spark keeps those for later ones.
    """
    counted = _training_texts(docs, documents).mapInArrow(lambda batches: _count(_label(batches)), _COUNTED)
    return _fitted(counted, log_odds)


def scan(text: str, models: Models) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all spans by start, then kind; the score of base spans is null."""
    base = base_spans(text)
    out = [(x.kind, x.start, x.end, None) for x in base]
    for x in other_runs(text, base):
        if (score := models.score(x.value)) > models.log_odds:
            out.append((x.kind, x.start, x.end, score))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redact(text: str, spans: list[tuple]) -> str:
    """The text with each span, or run of overlapping spans, replaced by [kind] of the first."""
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, models: Models) -> DataFrame:
    """The documents with `secrets`, an array of spans by start and then kind, and `redacted`, the text without them.

    A null text has no spans and stays null; columns of the same names are replaced. Whole texts
    are scanned, row by row: nothing is shuffled and the rows stay where they are. A text goes to
    the Python worker and back once; what comes back besides it are texts with secrets only.
    """
    text = F.col("text").cast("string")
    kept = [c for c in docs.columns if c not in ("secrets", "redacted")]
    # A text that is no plain string is handed on as it is, beside the string that is scanned.
    plain = {f.name for f in docs.schema if f.name == "text" and f.dataType == StringType()}
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept if c not in plain)).alias("row"), text.alias("text"))
    schema = rows.select("row").schema.simpleString()[len("struct<row:") : -1]
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def step(batches: Batches) -> Batches:
        for batch in batches:
            for run in runs(batch, "text"):
                texts = run.column("text").to_pylist()
                found = [scan(x, models) if x else [] for x in texts]
                clean = [redact(x, spans) if spans else None for x, spans in zip(texts, found)]
                spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans] for spans in found]
                columns = [run.column("row"), run.column("text"), pa.array(spans, kinds), pa.array(clean, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "secrets", "redacted"])

    found = rows.mapInArrow(step, f"row {schema}, text string, secrets array<{SPAN}>, redacted string")
    own = (F.col("text") if c in plain else F.col("row").getField(c).alias(c) for c in kept)
    return found.select(*own, "secrets", F.coalesce("redacted", "text").alias("redacted"))


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
