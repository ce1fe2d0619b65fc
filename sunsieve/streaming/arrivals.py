"""Readings that keep arriving: row-wise steps on the stream, appends without repeats.

Steps that look at neighbouring rows are not run on the stream. They need rows that have
not arrived yet, so `reclean` runs them afterwards, on the days that a batch touched.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from sunsieve.operators.night import zero_at_night
from sunsieve.plans.clean import STEPS, Step, clean
from sunsieve.schema import DAY, MEASURES, STATION, TIME, TIME_FORMAT
from sunsieve.sources.files import aligned, parsed
from sunsieve.sources.shared import removed, shared_folder
from sunsieve.sources.tables import append_new, finish_replacement, one_per_key, read_table, replace_partitions, replace_table
from sunsieve.streaming.reach import changed_units, day_summaries

HEADER = (TIME, *MEASURES, STATION)


def arriving(
    spark: SparkSession, folder: str, header: Sequence[str] = HEADER, fmt: str = TIME_FORMAT
) -> DataFrame:
    """CSV files as they appear in a folder: typed, on the grid, dark at night."""
    text = StructType()
    for name in header:
        text = text.add(name, StringType())
    lines = spark.readStream.schema(text).option("header", True).option("enforceSchema", False).csv(folder)
    return zero_at_night(aligned(parsed(lines, fmt)))


def keep_appending(
    stream: DataFrame, table: str, checkpoint: str, grain: str = DAY, on_conflict: str = "keep"
) -> StreamingQuery:
    """Append what has arrived and stop; call again for what arrives later.

    A key enters the table once: repeats in a batch, across batches and from a batch
    that is replayed after a failure are left out. Repeats with other values follow
    `on_conflict`, as in `append_new`: by default what came first stays, and of those in
    one batch the smallest.
    """

    def add(batch: DataFrame, _: int) -> None:
        append_new(one_per_key(batch, on_conflict), table, grain, on_conflict)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _same_unit(left: DataFrame, units: DataFrame, how: str) -> DataFrame:
    """Join on station and day; null ones equal each other."""
    named = units.select(F.col(STATION).alias("_station"), F.col(DAY).alias("_day"))
    return left.join(named, F.col(STATION).eqNullSafe(F.col("_station")) & F.col(DAY).eqNullSafe(F.col("_day")), how)


def _on_days(table: DataFrame, units: DataFrame) -> DataFrame:
    """The table's partitions that the units lie in; their days are named in the filter, so no other is opened."""
    days = [r[DAY] for r in units.select(DAY).distinct().collect()]  # no more than the table has partitions
    return table.where(F.col(DAY).isin([d for d in days if d]) | (F.col(DAY).isNull() & F.lit(None in days)))


def _kept_summaries(spark: SparkSession, raw: str, touched: DataFrame) -> DataFrame:
    """One row per station and day of the raw table, kept beside it; those of the touched days are made anew."""
    path, stored = f"{raw}.days", read_table(spark, raw)
    known = read_table(spark, path)
    rows = stored
    if known is not None:
        days = touched.select(F.col(DAY).alias("_day"))
        rows = _on_days(stored, touched).join(days, F.col(DAY).eqNullSafe(F.col("_day")), "left_semi")
    day_summaries(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    return spark.read.parquet(path)


def reclean(
    raw: str, cleaned: str, days: DataFrame, steps: Sequence[Step] = STEPS, chunk_days: int = 8
) -> None:
    """Clean again what the touched days can change, from the table of raw readings into the table of cleaned ones.

    `days` holds dates in a column `day`, such as those of a batch; a null stands for rows
    without a time. Both tables are stored by day. What is rewritten, and what has to be read
    for it, follows from one summary row per station and day (see `changed_units`), so the
    cleaned table always equals a cleaning of everything, however long a gap is. Rows of a
    rewritten day that cannot have changed are taken over as they are.

    Steps of a caller can reach any distance: with such a step among them, and for the first
    cleaning, everything is cleaned. An interrupted call is repeated.
    """
    spark = days.sparkSession
    touched = days.select(F.col(DAY).cast("date").alias(DAY)).distinct()
    summaries = _kept_summaries(spark, raw, touched)
    finish_replacement(spark, cleaned)
    stored, before = read_table(spark, raw), read_table(spark, cleaned)
    aside = shared_folder(spark, "recleaned")
    try:
        if before is None or not all(getattr(s, "keeps_keys", False) for s in steps):
            clean(stored.drop(DAY), steps, chunk_days=chunk_days).write.parquet(f"{aside}/rows")
            replace_table(spark.read.parquet(f"{aside}/rows"), cleaned, DAY)
            return
        changed_units(summaries, touched).where("changed OR read").write.parquet(f"{aside}/units")
        units = spark.read.parquet(f"{aside}/units")
        changed = units.where("changed")
        rows = _same_unit(_on_days(stored, units), units, "left_semi").drop(DAY)
        out = clean(rows, steps, chunk_days=chunk_days).withColumn(DAY, F.col(TIME).cast("date"))
        out = _same_unit(out, changed, "left_semi")
        stays = _same_unit(_on_days(before, changed), changed, "left_anti")
        replace_partitions(out.unionByName(stays.select(out.columns)).drop(DAY), cleaned)
    finally:
        removed(spark, aside)
