"""Station files in CSV, sources in order of preference, the consolidated CSV."""

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunsieve.errors import EmptySource, SieveError, SourceError, SourceUnavailable, TransformError
from sunsieve.functions.values import blank_tokens
from sunsieve.operators.align import blank_null_tokens, on_grid, typed, with_deltas
from sunsieve.operators.checks import require_bounds, require_on_grid, require_unique
from sunsieve.schema import MEASURES, STATION, STATIONS, TIME_FORMAT, WRITTEN_FORMAT

Reader = Callable[[SparkSession, str | Sequence[str]], DataFrame]


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Columns as text, named by the header.

    A file whose header differs from the first one's is an error, not a silent
    shift of columns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("header", True).option("enforceSchema", False).csv(paths)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; times whole, to the microsecond, as the loader reads them."""
    df.write.option("header", True).option("timestampNTZFormat", WRITTEN_FORMAT).csv(path)


def read_first_available(
    spark: SparkSession, sources: Sequence[str], reader: Reader = read_csv
) -> DataFrame:
    """The first source that can be opened. One without even a header ends the search.

    A reader may say with a SourceError that a source is out of reach; the next is then tried.
    """
    last = None
    for source in sources:
        try:
            found = reader(spark, source)
        except (PySparkException, Py4JJavaError, SourceError) as cause:
            last = cause
            continue
        if not found.columns:
            raise EmptySource(f"{source} is empty")
        return found
    raise SourceUnavailable(f"none of {list(sources)} can be read, last error: {last}") from last


def consolidate(
    spark: SparkSession,
    source_dir: str,
    stations: int = STATIONS,
    file_name: str = "station{:02d}.csv",
) -> DataFrame:
    """The files of all stations as one frame, the station taken from the file name.

    Measures become doubles, the time stays text. A missing file is an error.
    """
    paths = [f"{source_dir}/{file_name.format(i)}" for i in range(stations)]
    try:
        text = read_csv(spark, paths)
    except PySparkException as cause:
        raise SourceUnavailable(f"not all of {stations} station files are in {source_dir}: {cause}") from cause
    station = F.regexp_extract("_metadata.file_path", r"station(\d+)\.csv", 1).cast("smallint")
    return text.select(
        *(blank_tokens(F.col(c)).cast("double").alias(c) if c in MEASURES else F.col(c) for c in text.columns),
        station.alias(STATION),
    )


def parsed(text: DataFrame, fmt: str = TIME_FORMAT) -> DataFrame:
    """Typed readings with the time as written, not floored."""
    return typed(blank_null_tokens(text), fmt)


def aligned(readings: DataFrame) -> DataFrame:
    """Parsed readings on the grid, with the forecast errors."""
    return with_deltas(on_grid(readings))


def validate(readings: DataFrame, strict_grid: bool = False) -> None:
    """Abort on duplicate keys (after flooring) and irradiance out of bounds.

    Flooring puts every time on the grid, so the grid is checked before it, and only
    on demand.
    """
    if strict_grid:
        require_on_grid(readings)
    floored = on_grid(readings)
    require_unique(floored)
    require_bounds(floored)


def load_readings(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = TIME_FORMAT,
    strict: bool = True,
    strict_grid: bool = False,
) -> DataFrame:
    """Read, parse, floor, cast, derive; validate unless told not to."""
    try:
        readings = parsed(read_csv(spark, paths), fmt)
        if strict:
            validate(readings, strict_grid)
        return aligned(readings)
    except SieveError:
        raise
    except Exception as cause:
        raise TransformError(f"loading {paths} failed: {cause}") from cause
