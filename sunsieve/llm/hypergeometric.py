"""A uniform shuffle into shards of exact sizes, planned by a hypergeometric communication matrix.

How many rows of each partition go to each shard is drawn first, from the law that a uniform
shuffle of all rows would give (multivariate hypergeometric). Each partition then deals its rows
to shards in a random order, rows are exchanged, and each shard is put in a random order again.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches
from sunsieve.sources.shared import landed

#: Rows of a shard that one task puts in order.
SLICE_ROWS = 50_000
#: numpy draws from fewer rows than this; beyond it the law is tabulated here.
NUMPY_ROWS = 10**9
#: Bits of a row's number that count within its partition, as in Spark's increasing ids.
PLACE_BITS = 33


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Counts of the shards, at most one apart; the first ones are the larger."""
    return np.full(shards, rows // shards) + (np.arange(shards) < rows % shards)


def communication_matrix(counts: Sequence[int], sizes: Sequence[int], seed: int) -> np.ndarray:
    """Rows that each partition (of these counts) sends to each shard (of these sizes), exactly."""
    left, rng = np.array(sizes, dtype=np.int64), np.random.default_rng(seed)
    if sum(counts) != left.sum():
        raise ValueError("partitions and shards hold different numbers of rows")
    out = np.zeros((len(counts), len(left)), dtype=np.int64)
    for k, n in enumerate(counts):
        total = left.sum()
        for s in range(len(left)):  # one shard after the other: each given those before it
            total -= left[s]
            out[k, s] = n if not total else draw(rng, int(left[s]), int(total), int(n))
            n -= out[k, s]
        left -= out[k]
    return out


def draw(rng: np.random.Generator, good: int, bad: int, n: int, numpy_rows: int = NUMPY_ROWS) -> int:
    """How many of n rows drawn without return from good + bad are good, by the hypergeometric law."""
    if good + bad < numpy_rows:
        return int(rng.hypergeometric(good, bad, n))
    first, last = max(0, n - bad), min(n, good)
    # The law by ratios of neighbours over all counts that have a share a double can tell from none.
    total = good + bad
    middle, variance = n * good / total, n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))
    reach = 40 * variance**0.5 + 100
    low, high = max(first, int(middle - reach)), min(last, int(middle + reach))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    shares = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(shares, rng.random() * shares[-1], side="right"))


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 0, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows with `shard` (0..shards-1, counts at most one apart) and `slot` (0.. in its shard).

    Rows may repeat and hold nulls; columns named shard or slot are replaced; an empty table stays
    empty. The rows are written to the shared folder first, each with its partition's number and its
    place there, so that every later pass deals it alike however Spark then cuts the files. The
    matrix has one row per input partition and one column per shard. A shard is put in order in
    slices of about `slice_rows` rows by a random key, so no task holds a whole shard.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    whole = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    rows = landed(rows.select(whole, F.monotonically_increasing_id().alias("at")), "rows")
    counted = rows.groupBy(F.shiftright("at", PLACE_BITS).alias("p")).count().collect()  # a row per partition
    counts = {r["p"]: r["count"] for r in counted}
    order = sorted(counts)
    total = sum(counts.values())
    matrix = communication_matrix([counts[p] for p in order], shard_sizes(total, shards), seed)
    plan = rows.sparkSession.sparkContext.broadcast(dict(zip(order, matrix)))
    row_type = rows.schema["row"].dataType.simpleString()

    def deal(batches: Batches) -> Batches:
        dealt: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.asarray(batch.column("at"))
            part, place = at >> PLACE_BITS, at & ((1 << PLACE_BITS) - 1)
            met = np.unique(part)
            dealt = {p: x for p, x in dealt.items() if p in met}  # files come one after the other
            to = np.empty(len(at), dtype=np.int32)
            for p in met:
                if p not in dealt:  # an unknown partition is an error
                    rng = np.random.default_rng([seed, int(p)])
                    dealt[p] = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), plan.value[int(p)]))
                to[part == p] = dealt[p][place[part == p]]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(to), batch.column("at")], names=["row", "shard", "at"])

    dealt = rows.mapInArrow(deal, f"row {row_type}, shard int, at long")
    dealt = dealt.select("row", "shard", F.xxhash64(F.lit(seed), "at").alias("key"))
    slices = max(1, -(-total // (shards * slice_rows)))
    part = F.floor((F.col("key") / float(2**64) + 0.5) * slices).cast("int")
    dealt = dealt.withColumn("slice", F.least(part, F.lit(slices - 1)))
    dealt = landed(dealt.repartition(max(1, shards * slices), "shard", "slice"), "dealt")
    # Where each slice of a shard begins: a scan over one row per slice.
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "slice").count()
    starts = starts.select("shard", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    within = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("key"))
    slots = dealt.withColumn("within", within).join(starts, ["shard", "slice"])
    slot = F.col("begin") + F.col("within") - 1
    return slots.select(*(F.col("row").getField(c).alias(c) for c in kept), "shard", slot.alias("slot"))
