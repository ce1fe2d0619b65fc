"""Hard negatives by a vertical scan that branches and bounds (BOND).

Rows lie in blocks of columns, one per dimension. An anchor meets a block dimension by dimension in
descending order of its own magnitudes; after some dimensions each row's score lies between its sum
so far and the least and most that the remaining dimensions, by the block's minima and maxima, can
add. Rows whose bounds miss what is searched leave the bitmap of candidates, until the exact rows
are left. A first scan finds the positives, the nearest rows of the anchor's label; their scores
give windows, in which a second scan finds the best rows of other labels.

Anchors come in chunks and meet every block: a stated set of queries against all rows. What leaves
a block is a few rows per anchor and window.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, maybe_broadcast, numbered
from sunsieve.sources.shared import landed

#: Rows of a block, anchors of a chunk, dimensions read between two looks at the bounds.
BLOCK, CHUNK, STRIDE = 8_192, 256, 8
SCALE = 256


def scaled_rows(df: DataFrame, id_col: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): rows with an id, a label and a usable vector of the usual length, as integers."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("int").alias("label"), v.alias("v"))
    # NaN and infinities fail the comparison with the largest finite number, or beat it.
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) <= 1.7976931348623157e308)), F.lit(False))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == F.lit(usual.d if usual else 0))
    return rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _packed(rows: DataFrame, most: int, name: str) -> DataFrame:
    """The rows in groups of about `most`, each one row: a number from 0, ids, labels and a column of values per dimension."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                flat = np.asarray(part.column("v").flatten(), dtype=np.int64)
                v = flat.reshape(part.num_rows, len(flat) // part.num_rows)
                reach = max(int(v.max(initial=0)), -int(v.min(initial=0)))
                if v.shape[1] * reach * reach >= 2**60:
                    raise ValueError(f"components up to {reach} give scores beyond 64 bits")
                ids = np.asarray(part.column("vec_id"), dtype="<i8").tobytes()
                labels = np.asarray(part.column("label"), dtype="<i4").tobytes()
                kind = "<i4" if reach < 2**31 else "<i8"
                columns = [np.ascontiguousarray(v[:, d]).astype(kind).tobytes() for d in range(v.shape[1])]
                arrays = [pa.array([ids]), pa.array([labels]), pa.array([columns], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["ids", "labels", "dims"])

    groups = rows.coalesce(max(1, -(-rows.count() // most))).mapInArrow(step, "ids binary, labels binary, dims array<binary>")
    groups = landed(groups.withColumn("_group", F.monotonically_increasing_id()), name)
    place = landed(numbered(groups.select("_group"), [F.col("_group")], name), f"{name}-numbers")
    return groups.join(maybe_broadcast(place, place.count()), "_group").drop("_group")


def _matrix(ids: bytes, dims: list[bytes]) -> np.ndarray:
    """A row per dimension."""
    wide = len(dims) and len(dims[0]) == len(ids)
    return np.array([np.frombuffer(x, "<i8" if wide else "<i4") for x in dims], dtype=np.int64).reshape(len(dims), len(ids) // 8)


class Block:
    """Rows by columns, with each dimension's extremes."""

    def __init__(self, ids: bytes, labels: bytes, dims: list[bytes]):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i4")
        self.columns = _matrix(ids, dims)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, narrow, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
        """Rows that stay and their scores; `narrow` says which may stay, given what each can reach.

        `alive` holds the rows to begin with; narrow(alive, low, high) gives a mask over them.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        most = np.maximum(anchor * self.low, anchor * self.high)[order]
        least = np.minimum(anchor * self.low, anchor * self.high)[order]
        most, least = (np.concatenate([np.cumsum(x[::-1])[::-1], [0]]) for x in (most, least))
        score = np.zeros(len(alive), dtype=np.int64)
        for at in range(0, len(order), stride):
            read = order[at : at + stride]
            score += anchor[read] @ self.columns[read[:, None], alive]
            end = at + len(read)
            stay = narrow(alive, score + least[end], score + most[end])
            if not stay.all():
                alive, score = alive[stay], score[stay]
            if not len(alive):
                break
        return alive, score


def best_of(k: int):
    """Narrow to rows that may be among the k best."""

    def narrow(alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(alive) <= k:
            return np.ones(len(alive), dtype=bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]

    return narrow


def inside(windows: np.ndarray, k: int):
    """Narrow to rows that may be among the k best of any window (low, high), both included."""

    def narrow(alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(alive), dtype=bool)
        for start, end in windows:
            may = (high >= start) & (low <= end)
            sure = low[(low >= start) & (high <= end)]
            if len(sure) > k:
                may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stay |= may
        return stay

    return narrow


def _met(asked: DataFrame, blocks: DataFrame, step, schema: str) -> DataFrame:
    """Every chunk of anchors with every block, by the block's number; `asked` has a row per chunk."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks.count() - 1).cast("long"))
    chunks = asked.withColumn("block", F.explode(every))
    return chunks.join(blocks, "block").mapInArrow(step, schema)


def _positives(anchors: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(chunk, place, anchor_id, vec_id, score) of each anchor's best rows of its label, a row per vec_id."""
    names = ["chunk", "place", "anchor_id", "vec_id", "score"]

    def step(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["ids"], row["labels"], row["dims"])
                asked, labels, out = np.frombuffer(row["a_ids"], "<i8"), np.frombuffer(row["a_labels"], "<i4"), []
                queries = _matrix(row["a_ids"], row["a_dims"]).T
                for place, (anchor, label, v) in enumerate(zip(asked, labels, queries)):
                    alive = np.flatnonzero((block.labels == label) & (block.ids != anchor))
                    # An id that repeats counts once: the cut leaves room for its other rows.
                    copies = len(alive) - len(np.unique(block.ids[alive]))
                    alive, score = block.scan(v, alive, best_of(k + copies))
                    best = np.lexsort((block.ids[alive], -score))[: k + copies]
                    ids, s = block.ids[alive][best], score[best]
                    fixed = (np.full(len(ids), x) for x in (row["chunk"], place, anchor))
                    out.append((*fixed, ids, s))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=names)

    found = _met(anchors, blocks, step, ", ".join(f"{c} long" for c in names))
    found = found.groupBy("chunk", "place", "anchor_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def _negatives(anchors: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(chunk, place, window, vec_id, score) of the best rows of other labels in each window of an anchor."""
    names = ["chunk", "place", "window", "vec_id", "score"]

    def step(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["ids"], row["labels"], row["dims"])
                labels, out = np.frombuffer(row["a_labels"], "<i4"), [np.zeros((5, 0), dtype=np.int64)]
                queries, asked = _matrix(row["a_ids"], row["a_dims"]).T, np.frombuffer(row["a_ids"], "<i8")
                for x in row["windows"]:
                    place, windows = x["place"], np.array([(w["low"], w["high"]) for w in x["windows"]], dtype=np.int64)
                    # The anchor's own id, under whatever label, is no negative.
                    alive = np.flatnonzero((block.labels != labels[place]) & (block.ids != asked[place]))
                    copies = len(alive) - len(np.unique(block.ids[alive]))
                    alive, score = block.scan(queries[place], alive, inside(np.unique(windows, axis=0), k + copies))
                    for w, (start, end) in enumerate(windows):  # numbered as they are sorted
                        own = np.flatnonzero((score >= start) & (score <= end))
                        own = own[np.lexsort((block.ids[alive[own]], -score[own]))[: k + copies]]
                        n = len(own)
                        if n:
                            fixed = [np.full(n, y) for y in (row["chunk"], place, w)]
                            out.append(np.array([*fixed, block.ids[alive[own]], score[own]], dtype=np.int64))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, np.concatenate(out, axis=1))), names=names)

    found = _met(anchors, blocks, step, ", ".join(f"{c} long" for c in names))
    found = found.groupBy("chunk", "place", "window", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("chunk", "place", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    asked: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    id_col: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x) and scores are exact integer inner products. Anchors are the
    rows with `asked`, a condition on vec_id and label. For each anchor and each of its `positives`
    best other rows of the same label, the `negatives` best rows of other labels whose score lies
    between the two percentages of the positive's, both included; ties go to the smaller vec_id.

    Rows without an id or a label, or whose vector is null, of another length than most or has null
    or non-finite components, take no part. Rows that repeat an id and a label count once, with
    their better score; a row is never its own id's positive or negative; equal anchors are one.
    Scores that could leave 64 bits are an error. Fewer rows than asked for give all of them, an
    empty table gives none, and other columns are not read.
    """
    spark = df.sparkSession
    rows = landed(scaled_rows(df, id_col, vector, label, scale), "scaled")
    blocks = _packed(rows, BLOCK, "block")
    anchors = _packed(rows.where(asked).distinct(), CHUNK, "chunk")
    chunk = anchors.select("chunk", F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("dims").alias("a_dims"))
    if anchors.isEmpty():
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    known = landed(_positives(chunk, blocks, positives), "positives")
    # low * p <= 100 n <= high * p in whole numbers, rounded inwards.
    low, high = -_floored(-window[0] * F.col("score")), _floored(window[1] * F.col("score"))
    known = known.select("*", low.alias("low"), high.alias("high")).where("low <= high")
    by_score = Window.partitionBy("chunk", "place").orderBy(F.desc("score"), "vec_id")
    known = landed(known.withColumn("window", F.row_number().over(by_score).cast("long") - 1), "windows")
    of = known.groupBy("chunk", "place").agg(F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("windows"))
    of = of.groupBy("chunk").agg(F.collect_list(F.struct("place", "windows")).alias("windows"))
    found = _negatives(chunk.join(of, "chunk"), blocks, negatives)
    found = found.select("chunk", "place", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = found.join(known.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["chunk", "place", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _floored(percents: Column) -> Column:
    """A hundredth of a whole number, down to the next whole number."""
    return F.call_function("div", percents - F.pmod(percents, F.lit(100)), F.lit(100).cast("long"))
