"""Questions asked of readings and of the published table."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunsieve.errors import QueryError, SieveError
from sunsieve.schema import MAX_SCAN_BYTES, STATION, TARGET, TIME
from sunsieve.sources.footers import data_files, with_chunk_bytes
from sunsieve.sources.tables import moment, partition_of, read_table, stored_grain, time_range

Moment = str | datetime

#: What a query of average power reads.
AVERAGE_COLUMNS = (STATION, TIME, TARGET)


def average_power(df: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Average power of each station from start to end, both included."""
    return (
        time_range(df, start, end)
        .groupBy(STATION)
        .agg(F.avg(TARGET).alias("avg_power"))
        .orderBy(STATION)
    )


def average_power_sql(df: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """The same as SQL with bound parameters; values never become query text."""
    text = f"""
        SELECT {STATION}, avg({TARGET}) AS avg_power
        FROM {{readings}}
        WHERE {TIME} BETWEEN CAST(:start AS TIMESTAMP_NTZ) AND CAST(:end AS TIMESTAMP_NTZ)
        GROUP BY {STATION} ORDER BY {STATION}
    """
    bound = {"start": str(start), "end": str(end)}
    return df.sparkSession.sql(text, args=bound, readings=df)


def result_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def station_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(STATION).agg(F.count("*").alias("n_rows")).orderBy(STATION)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows by station and time."""
    return df.orderBy(STATION, TIME).limit(n)


def scan_estimate(
    spark: SparkSession,
    table: str,
    start: Moment,
    end: Moment,
    grain: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Partitions, files and bytes a query over the range would open, without reading any row.

    The files are those of the table's partitions in the range, by Spark's own listing, which is
    pruned before it is counted. With `columns`, bytes are those of their chunks, which a scan of
    just these columns reads: tasks take them from the files' footers. Without, whole files count.
    """
    return _estimated(spark, table, _stored(spark, table, grain), start, end, columns)


def _estimated(
    spark: SparkSession, table: str, stored: DataFrame, start: Moment, end: Moment, columns: Sequence[str] | None
) -> DataFrame:
    if columns is not None and (unknown := sorted(set(columns) - set(stored.columns))):
        raise QueryError(f"no column {unknown} in {table}")
    grain = stored_grain(stored)
    files = data_files(spark, table, stored.schema[grain])
    low, high = (partition_of(moment(m), grain) for m in (start, end))
    files = files.where(F.col(grain).between(low, high))
    size = F.col("length") if columns is None else F.col("bytes")
    if columns is not None:
        files = with_chunk_bytes(files, columns, grain)
    return files.agg(
        F.count_distinct(grain).alias("partitions"), F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("bytes")
    )


def _stored(spark: SparkSession, table: str, grain: str | None) -> DataFrame:
    stored = read_table(spark, table)
    if stored is None:
        raise QueryError(f"no table at {table}")
    if grain and stored_grain(stored) != grain:
        raise QueryError(f"{table} is stored by {stored_grain(stored)}, not by {grain}")
    return stored


def query_average_power(
    spark: SparkSession,
    table: str,
    start: Moment,
    end: Moment,
    dry_run: bool = False,
    max_bytes: int = MAX_SCAN_BYTES,
    grain: str | None = None,
) -> DataFrame:
    """Average power from the table; the estimate alone when dry, a QueryError above the cap."""
    try:
        stored = _stored(spark, table, grain)
        estimate = _estimated(spark, table, stored, start, end, AVERAGE_COLUMNS)
        if dry_run:
            return estimate
        size = estimate.first()["bytes"]
        if size > max_bytes:
            raise QueryError(f"the query would scan {size} bytes, {max_bytes} are allowed")
        return average_power(stored, start, end)
    except SieveError:
        raise
    except Exception as cause:
        raise QueryError(f"average power from {table} failed: {cause}") from cause


@dataclass(frozen=True)
class Answer:
    """A query's rows, one per station, with their number and the bytes of the columns behind them."""

    rows: list[dict]
    total_rows: int
    bytes_processed: int


def answer_average_power(
    spark: SparkSession, table: str, start: Moment, end: Moment, max_bytes: int = MAX_SCAN_BYTES
) -> Answer:
    """The answer as a service gives it: collected, with totals; every failure is a QueryError."""
    try:
        size = scan_estimate(spark, table, start, end, columns=AVERAGE_COLUMNS).first()["bytes"]
        rows = [r.asDict() for r in query_average_power(spark, table, start, end, max_bytes=max_bytes).collect()]
        return Answer(rows, len(rows), size)
    except QueryError:
        raise
    except Exception as cause:
        raise QueryError(f"average power from {table} failed: {cause}") from cause
