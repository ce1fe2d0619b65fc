"""What several operators share: tables, bounded batches, files in the shared folder."""

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunsieve.sources.shared import landed

#: Rows up to which a side of a join is broadcast; above it the join shuffles.
BROADCAST_ROWS = 500_000

#: What workers must be able to import; a cluster that has the package installed needs nothing else.
ROOT = str(Path(__file__).resolve().parents[2])

Batches = Iterator[pa.RecordBatch]


def workers_find_us(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package whatever folder they start in."""
    env = spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark; makes sure that workers can import what it is given to."""
    workers_find_us(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def runs(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose values in `column` hold about `most` bytes."""
    if not batch.num_rows:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    at = np.cumsum(np.asarray(length, dtype=np.int64) + 64) // most
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def maybe_broadcast(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side with a broadcast hint if its counted rows are few; the join shuffles it otherwise."""
    return F.broadcast(df) if rows <= most else df


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """The rows with their place in the order, from 0; ties are settled by no more than the order.

    Rows are cut into ranges and written with their range's number, so that no task holds all of
    them; a scan over one row per range gives where each begins.
    """
    parts = landed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = parts.withColumn("_within", within).join(F.broadcast(starts), "_part")  # a row per partition
    return placed.withColumn(name, (F.col("_begin") + F.col("_within") - 1).cast("long")).drop("_part", "_begin", "_within")


def open_store(url: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file that all executors reach, and the path in it."""
    return fs.FileSystem.from_uri(url)
