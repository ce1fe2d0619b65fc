"""The published file, the partitioned table, and appends that can be repeated."""

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from sunsieve.errors import LoadError, SieveError
from sunsieve.operators.align import enforce_schema
from sunsieve.schema import COMPRESSION, DAY, GOLD_PREFIX, LOAD_PREFIX, STATION, TIME
from sunsieve.sources.footers import data_files
from sunsieve.sources.shared import removed

MONTH = "month"
GRAINS = (DAY, MONTH)
KEY = (STATION, TIME)


def partition_of(time: Column, grain: str) -> Column:
    """First date of the partition a time belongs to."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    date = time.cast("date")
    return date if grain == DAY else F.trunc(date, "month")


def gold_path(root: str, run_id: str | None = None) -> str:
    """Target of a run; the id defaults to the UTC second."""
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{root.rstrip('/')}/{GOLD_PREFIX}{run_id}.parquet"


def export_gold(df: DataFrame, root: str, run_id: str | None = None) -> str:
    """Write the final columns as compressed Parquet and return where."""
    path = gold_path(root, run_id)
    enforce_schema(df).write.option("compression", COMPRESSION).parquet(path)
    return path


def stored_grain(table: DataFrame) -> str:
    """The grain a stored table is partitioned by."""
    found = [g for g in GRAINS if g in table.columns]
    if len(found) != 1:
        raise LoadError(f"the table has {found or 'neither'} of the partitions {GRAINS}")
    return found[0]


def _clustered(df: DataFrame, grain: str) -> DataFrameWriter:
    """A writer of the rows, one folder per day or month, rows sorted by station.

    `rebalance` gathers the rows of a partition so that it gets few files, and
    splits it again where it is larger than the advisory size: no task has to write
    a partition that outgrows it.
    """
    rows = df.withColumn(grain, partition_of(F.col(TIME), grain)).hint("rebalance", grain)
    rows = rows.sortWithinPartitions(grain, *KEY)
    return rows.write.partitionBy(grain).option("compression", COMPRESSION)


def append_clustered(df: DataFrame, table: str, grain: str = DAY) -> None:
    """Append to the table. A table stored by another grain is refused, it could not be read again."""
    stored = read_table(df.sparkSession, table)
    if stored is not None and stored_grain(stored) != grain:
        raise LoadError(f"{table} is stored by {stored_grain(stored)}, not by {grain}")
    _clustered(df, grain).mode("append").parquet(table)


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None before the first append. One whose replacement broke is refused."""
    if _note(spark, _replacing(table)) is not None:
        raise LoadError(f"a replacement in {table} broke; the next append finishes it")
    return _stored_table(spark, table)


def _stored_table(spark: SparkSession, table: str) -> DataFrame | None:
    try:
        return spark.read.parquet(table)
    except AnalysisException as cause:
        if cause.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def moment(value: str | datetime) -> Column:
    """A zone-less time literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def time_range(df: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Rows from start to end, both included.

    Spark does not derive the partition from the time, so the range of partitions is
    stated too; that is what keeps the other folders unread.
    """
    low, high = moment(start), moment(end)
    rows = df.where(F.col(TIME).between(low, high))
    for grain in GRAINS:
        if grain in df.columns:
            rows = rows.where(F.col(grain).between(partition_of(low, grain), partition_of(high, grain)))
    return rows


def _sums(columns: Sequence[str]) -> list[Column]:
    cells = [x for c in sorted(columns) for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    sums = (F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).alias(f"sum_{seed}") for seed in (1, 2))
    return [F.count("*").alias("n_rows"), *sums]


def _spelled(sums: DataFrame) -> DataFrame:
    content = F.concat_ws(":", *(F.col(f"sum_{seed}").cast("string") for seed in (1, 2)))
    return sums.select("n_rows", content.alias("content"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a content hash, the same for any order and partitioning.

    A column's value and whether it is null are hashed, so a value that moves to
    another column shows. Two independent hashes are added up over the rows: unlike
    an XOR, equal rows do not cancel in a sum.
    """
    return _spelled(df.agg(*_sums(df.columns)))


def partition_sums(stored: DataFrame, grain: str) -> DataFrame:
    """The sums behind the fingerprint, for each partition of a stored table."""
    return stored.groupBy(grain).agg(*_sums([c for c in stored.columns if c != grain]))


def kept_fingerprint(spark: SparkSession, table: str) -> DataFrame:
    """The fingerprint of a stored table without its partition column, from sums kept per partition.

    `<table>.sums` holds the sums of each partition and the names and lengths of the files they
    were taken from, as a hash. Only partitions whose files are others now are read; sums of the
    rest are added up.
    """
    stored = read_table(spark, table)
    if stored is None:
        raise LoadError(f"no table at {table}")
    grain, path = stored_grain(stored), f"{table}.sums"
    named = F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).cast("string").alias("files")
    now = data_files(spark, table, stored.schema[grain]).groupBy(grain).agg(named)
    same = F.col(grain).eqNullSafe(F.col("_part")) & (F.col("files") == F.col("_files"))
    kept = _stored_table(spark, path)
    if kept is not None:
        old = kept.select(F.col(grain).alias("_part"), F.col("files").alias("_files"))
        now = now.join(old, same, "left_anti")
    changed = now.collect()  # a row per changed partition
    if changed:
        days = [r[grain] for r in changed]
        rows = stored.where(F.col(grain).isin([d for d in days if d]) | (F.col(grain).isNull() & F.lit(None in days)))
        files = spark.createDataFrame(changed, f"{grain} date, files string").withColumnRenamed(grain, "_part")
        fresh = partition_sums(rows, grain).join(files, F.col(grain).eqNullSafe(F.col("_part"))).drop("_part")
        fresh.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(grain).parquet(path)
    current = data_files(spark, table, stored.schema[grain]).select(F.col(grain).alias("_part")).distinct()
    kept = spark.read.parquet(path).join(current, F.col(grain).eqNullSafe(F.col("_part")), "left_semi")
    return _spelled(kept.agg(F.sum("n_rows").alias("n_rows"), *(F.sum(f"sum_{k}").alias(f"sum_{k}") for k in (1, 2))))


def load_id(uri: Column, project: Column, dataset: Column, table: Column, content: Column) -> Column:
    """Name of a load, fixed by where from, where to and what."""
    return F.concat(F.lit(LOAD_PREFIX), F.md5(F.concat(uri, project, dataset, table, content)))


def _stored_near(batch: DataFrame, table: DataFrame, grain: str) -> DataFrame:
    """The table's rows in the partitions that the batch touches; the others are not read.

    One row per partition of the batch meets the table on the partition column, so a
    stray old row costs its own partition and no other.
    """
    parts = batch.select(partition_of(F.col(TIME), grain).alias("_part")).distinct()
    return table.join(parts, F.col(grain).eqNullSafe(F.col("_part")), "left_semi")


def _matched(batch: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """Join on the key; null keys equal each other, so rows without a time are not added twice."""
    named = known.select(*(F.col(c).alias(f"_known_{c}") for c in known.columns))
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in KEY]
    return batch.join(named, same[0] & same[1], how)


def without_known(batch: DataFrame, table: DataFrame, grain: str = DAY) -> DataFrame:
    """Rows of the batch whose key the table does not hold."""
    return _matched(batch, _stored_near(batch, table, grain).select(*KEY), "left_anti")


def conflicts(batch: DataFrame, table: DataFrame, grain: str = DAY) -> DataFrame:
    """Keys that the table holds with other values than the batch."""
    rest = [c for c in batch.columns if c not in KEY and c in table.columns]
    both = _matched(batch, _stored_near(batch, table, grain).select(*KEY, *rest), "inner")
    equal = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in rest]
    return both.where(~reduce(lambda a, b: a & b, equal, F.lit(True))).select(*KEY).distinct()


def one_per_key(batch: DataFrame, on_conflict: str = "error") -> DataFrame:
    """The batch with each key once, whatever the order of its rows.

    Equal repeats are one row. Of repeats with different values the smallest row stays,
    columns compared in order, or the rows are refused while running ("error").
    """
    rest = [c for c in batch.columns if c not in KEY]
    least, most = F.min(F.struct(*rest)).alias("_row"), F.max(F.struct(*rest)).alias("_last")
    rows = batch.groupBy(*KEY).agg(least, most)
    if on_conflict == "error":
        text = F.concat(F.lit("rows of one station and time differ, at "), F.coalesce(F.col(TIME).cast("string"), F.lit("no time")))
        rows = rows.where(F.when(F.col("_row").eqNullSafe(F.col("_last")), F.lit(True)).otherwise(F.raise_error(text)))
    return rows.select(*KEY, "_row.*").select(*batch.columns)


def append_new(batch: DataFrame, table: str, grain: str = DAY, on_conflict: str = "error") -> None:
    """Append the rows whose key is not in the table yet.

    Where the table has the key with other values, `on_conflict` says what holds:
    "error" refuses the batch with their count and a sample, "keep" leaves the stored
    row, "replace" takes the new one and rewrites the partitions it lies in.

    What a replacement writes is noted beside the table until it is in place: one that broke
    is finished before anything is appended, and until then the table cannot be read here.
    """
    if on_conflict not in ("error", "keep", "replace"):
        raise ValueError("on_conflict must be error, keep or replace")
    spark = batch.sparkSession
    finish_replacement(spark, table, grain)
    known = read_table(spark, table)
    if known is None:
        return append_clustered(batch, table, grain)
    if stored_grain(known) != grain:
        raise LoadError(f"{table} is stored by {stored_grain(known)}, not by {grain}")
    if on_conflict == "keep":
        return append_clustered(without_known(batch, known, grain), table, grain)
    other = conflicts(batch, known, grain)
    n = other.count()
    if n and on_conflict == "error":
        sample = [r.asDict() for r in other.orderBy(*KEY).limit(5).collect()]
        raise LoadError(f"{table} holds {n} keys of the batch with other values, such as {sample}")
    if not n:
        return append_clustered(without_known(batch, known, grain), table, grain)
    # What stays of the touched partitions, then the batch.
    stays = _matched(_stored_near(batch, known, grain).select(*batch.columns), batch.select(*KEY), "left_anti")
    replace_partitions(stays.unionByName(batch), table, grain)


def replace_partitions(rows: DataFrame, table: str, grain: str = DAY) -> None:
    """Write the rows in place of the partitions they touch; other partitions stay.

    The rows may come from the table itself: they are written aside first, and a replacement that
    breaks is finished from there.
    """
    spark, aside = rows.sparkSession, f"{table}.aside-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(aside)
    except Exception:
        removed(spark, aside)
        raise
    if not _noted(spark, _replacing(table), aside):
        removed(spark, aside)
        raise LoadError(f"another replacement in {table} has begun")
    finish_replacement(spark, table, grain)


def _replacing(table: str) -> str:
    return f"{table}.replacing"


def finish_replacement(spark: SparkSession, table: str, grain: str = DAY) -> None:
    """Put in place what a replacement has written aside, if one has begun; as often as need be."""
    aside = _note(spark, _replacing(table))
    if aside is None:
        return
    overwrite_partitions(spark.read.parquet(aside), table, grain)
    removed(spark, _replacing(table))
    removed(spark, aside)


def _store(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _noted(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with a text; False if there is one already. As atomic as the store's own create."""
    store, where = _store(spark, path)
    try:
        out = store.create(where, False)
    except Py4JJavaError:
        if store.exists(where):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    store, where = _store(spark, path)
    if not store.exists(where):
        return None
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def overwrite_partitions(rows: DataFrame, table: str, grain: str = DAY) -> None:
    """Write the rows in place of the partitions they touch; other partitions stay."""
    _clustered(rows, grain).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table)


def compact(spark: SparkSession, table: str, most_files: int = 2, file_bytes: int = 128 << 20) -> DataFrame:
    """Write partitions of many small files anew, in few; gives (partition, files, bytes) of those before.

    Small arrivals leave a file each. A partition is written anew if it has more than `most_files`
    files and more than its bytes need in files of `file_bytes`; the others are not read. Its rows
    are written aside and put in place of it (see `replace_partitions`), so a compaction that breaks
    is finished by the next append or compaction. A query that is reading such a partition
    meanwhile can fail and has to be asked again; no query sees a row twice.
    """
    stored = _stored_table(spark, table)
    if stored is None:
        raise LoadError(f"no table at {table}")
    grain = stored_grain(stored)
    finish_replacement(spark, table, grain)
    sizes = data_files(spark, table, stored.schema[grain]).groupBy(grain).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    needed = F.greatest(F.lit(most_files), F.ceil(F.col("bytes") / file_bytes))
    many = sizes.where(F.col("files") > needed).collect()  # a row per such partition
    found = spark.createDataFrame(many, f"{grain} date, files long, bytes long")
    if many:
        days = [r[grain] for r in many]
        rows = spark.read.parquet(table).where(F.col(grain).isin([d for d in days if d]) | (F.col(grain).isNull() & F.lit(None in days)))
        replace_partitions(rows.drop(grain), table, grain)
    return found


def replace_table(rows: DataFrame, table: str, grain: str = DAY) -> None:
    """Write the rows in place of all that the table holds."""
    _clustered(rows, grain).mode("overwrite").option("partitionOverwriteMode", "static").parquet(table)


def load_once(
    spark: SparkSession,
    uri: str,
    table: str,
    root: str,
    project: str = "",
    dataset: str = "",
    name: str = "",
    grain: str = DAY,
    on_conflict: str = "error",
    resume: bool = False,
) -> str:
    """Add a published file to the table; a second call with the same file changes nothing.

    A file with other values for keys of the table is refused, unless `on_conflict` says
    otherwise (see `append_new`); a refused load is not noted. A load first creates a note of its
    begin, which only one can, and is noted in `<table>.loads` after the rows are in: of two
    loaders of one file the second is refused while the first is at work. A load that fails takes
    its begin back, and as rows are matched by key it is finished by calling again; one that was
    killed leaves it, and `resume` says that nobody is at work any more. Loads of different files
    into one table are still to come one after the other, as plain Parquet has no transactions.
    """
    if not uri.startswith(root.rstrip("/") + "/"):
        raise LoadError(f"{uri} is not below {root}")
    try:
        batch = spark.read.parquet(uri)
        mark = fingerprint(batch).select(F.concat_ws(":", "n_rows", "content").alias("content"))
        identity = load_id(F.lit(uri), F.lit(project), F.lit(dataset), F.lit(name or table), F.col("content"))
        this = mark.select(identity.alias("load_id")).first()["load_id"]
        ledger = f"{table}.loads"
        done = read_table(spark, ledger)
        if done is not None and not done.where(F.col("load_id") == this).isEmpty():
            return this
        begun = f"{table}.begun-{this}"
        if not _noted(spark, begun, uri) and not resume:
            raise LoadError(f"a load of {uri} has begun; resume it if nobody is at work on it")
        try:
            append_new(batch, table, grain, on_conflict)
        except Exception:
            removed(spark, begun)
            raise
        note = spark.range(1).select(F.lit(this).alias("load_id"), F.lit(uri).alias("uri"))
        note.write.mode("append").parquet(ledger)
        removed(spark, begun)
        return this
    except SieveError:
        raise
    except Exception as cause:
        raise LoadError(f"loading {uri} into {table} failed: {cause}") from cause
