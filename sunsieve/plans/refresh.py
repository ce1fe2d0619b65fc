"""From raw files to the published table, in one call."""

import itertools
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunsieve.errors import LoadError, SieveError, TransformError
from sunsieve.operators.align import on_grid
from sunsieve.operators.checks import quality_report, require_clean_bounds, require_on_grid, require_unique
from sunsieve.plans.clean import STEPS, Step, clean_measured
from sunsieve.schema import DAY, TIME_FORMAT
from sunsieve.sources.files import Reader, aligned, parsed, read_csv, read_first_available
from sunsieve.sources.shared import file_sizes, removed, shared_folder
from sunsieve.sources.tables import export_gold, load_once


@dataclass(frozen=True)
class Refreshed:
    """What was published and loaded, what each step that ran changed, and the state of the data before them."""

    uri: str
    load_id: str
    metrics: DataFrame
    report: DataFrame


def refresh(
    spark: SparkSession,
    sources: Sequence[str],
    root: str,
    table: str,
    run_id: str | None = None,
    steps: Sequence[Step] = STEPS,
    reader: Reader = read_csv,
    fmt: str = TIME_FORMAT,
    grain: str = DAY,
    strict_grid: bool = False,
    on_conflict: str = "error",
    work_dir: str | None = None,
) -> Refreshed:
    """Read the first source at hand, validate, clean, publish, load.

    The text is parsed once and written below `work_dir` (by default the shared folder);
    validation and cleaning read the columns they need from there. The cleaned rows are
    written there too, with what each step changed; the published file, the load and the
    metrics come from these (see `clean_measured`). All of it is removed in the end. Bounds,
    nulls and grid are one pass and come back as the report, off-grid times included, whether
    or not they abort. A file whose load is refused is taken back. Failures are SieveErrors.
    """
    aside = f"{work_dir.rstrip('/')}/readings-{uuid.uuid4().hex}" if work_dir else shared_folder(spark, "readings")
    parts = itertools.count()

    def land(rows: DataFrame) -> DataFrame:
        path = f"{aside}/{next(parts)}"
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    try:
        readings = land(parsed(read_first_available(spark, sources, reader), fmt))
        state = quality_report(readings)
        report = state.collect()
        if strict_grid:
            require_on_grid(readings)
        require_unique(on_grid(readings))
        require_clean_bounds(report)
        cleaned, metrics = clean_measured(aligned(readings), land, steps)
        uri = export_gold(cleaned, root, run_id)
        try:
            identity = load_once(spark, uri, table, root, grain=grain, on_conflict=on_conflict)
        except LoadError:
            removed(spark, uri)
            raise
        written = F.lit(sum(file_sizes(spark, uri).values())).cast("bigint")
        metrics = metrics.withColumn("bytes_written", written)
        return Refreshed(uri, identity, metrics, spark.createDataFrame(report, state.schema))
    except SieveError:
        raise
    except Exception as cause:
        raise TransformError(f"refreshing {table} failed: {cause}") from cause
    finally:
        removed(spark, aside)
