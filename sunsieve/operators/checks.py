"""Data-quality reports, and the checks that abort on them.

Reports are frames of (check, column, violations, min_value, max_value).
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sunsieve.errors import AlignmentError, BoundsError, TransformError
from sunsieve.functions.grid import minutes_between, off_grid
from sunsieve.functions.values import out_of_bounds
from sunsieve.operators.series import by_chunk, per_piece, with_nearby
from sunsieve.schema import EXPECTED_ROWS, GRID_MINUTES, IRRADIANCE, MEASURES, STATION, TIME


def _unpivoted(df: DataFrame, checks: dict[tuple[str, str], tuple[Column, Column, Column]]) -> DataFrame:
    """One aggregation over the frame, then one row per (check, column)."""
    rows = F.array(
        *(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                violations.cast("bigint").alias("violations"),
                low.cast("double").alias("min_value"),
                high.cast("double").alias("max_value"),
            )
            for (check, column), (violations, low, high) in checks.items()
        )
    )
    return df.agg(rows.alias("_rows")).select(F.inline("_rows"))


def _bounds(columns: Sequence[str]) -> dict:
    found = {}
    for c in columns:
        bad = F.when(out_of_bounds(F.col(c)), F.col(c))
        found["bounds", c] = (F.count(bad), F.min(bad), F.max(bad))
    return found


def _nulls(columns: Sequence[str]) -> dict:
    none = F.lit(None)
    return {("nulls", c): (F.count_if(F.col(c).isNull()), none, none) for c in columns}


def _grid(time: str, minutes: int) -> dict:
    bad = F.when(off_grid(F.col(time), minutes), F.minute(time))
    return {("off_grid", time): (F.count(bad), F.min(bad), F.max(bad))}


def irradiance_bounds(df: DataFrame, columns: Sequence[str] = IRRADIANCE) -> DataFrame:
    """Values outside the physical range: how many, lowest, highest."""
    return _unpivoted(df, _bounds(columns))


def null_counts(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Nulls of every column that has some."""
    counts = _unpivoted(df, _nulls([c for c in columns if c in df.columns]))
    return counts.select("column", F.col("violations").alias("nulls")).where("nulls > 0")


def off_grid_times(df: DataFrame, time: str = TIME, minutes: int = GRID_MINUTES) -> DataFrame:
    """Times off the grid; ask before flooring, afterwards there are none."""
    return _unpivoted(df, _grid(time, minutes))


def quality_report(df: DataFrame, minutes: int = GRID_MINUTES) -> DataFrame:
    """Bounds, nulls and grid in one pass over parsed, unfloored rows."""
    return _unpivoted(df, {**_bounds(IRRADIANCE), **_nulls(MEASURES), **_grid(TIME, minutes)})


def duplicate_keys(df: DataFrame, keys: Sequence[str] = (STATION, TIME)) -> DataFrame:
    """Keys held by more than one row, null keys included."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def row_count(df: DataFrame, expected: int = EXPECTED_ROWS) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(expected).cast("bigint").alias("expected"), (F.col("n_rows") == expected).alias("ok")
    )


@by_chunk
def _steps(df: DataFrame) -> DataFrame:
    """Time of the row before in the same station, at any distance."""
    rows = with_nearby(df, [], before=1)
    before = F.lag(TIME).over(per_piece([TIME]))
    return rows.withColumn("previous", before).where(~F.col("_nearby")).drop("_nearby")


def gaps(df: DataFrame, minutes: int = GRID_MINUTES) -> DataFrame:
    """Steps within a station that are longer than the grid."""
    step = minutes_between(F.col("previous"), F.col(TIME))
    return (
        _steps(df.select(STATION, TIME))
        .select(STATION, "previous", TIME, step.alias("gap_minutes"))
        .where(F.col("gap_minutes") > minutes)
    )


def require_rows(df: DataFrame, expected: int = EXPECTED_ROWS) -> None:
    found = row_count(df, expected).first()
    if not found["ok"]:
        raise TransformError(f"expected {expected} rows, found {found['n_rows']}")


def require_unique(df: DataFrame) -> None:
    twice = duplicate_keys(df)
    groups = twice.count()
    if groups:
        sample = [r.asDict() for r in twice.orderBy(STATION, TIME).limit(5).collect()]
        raise AlignmentError(f"{groups} duplicate times per station, such as {sample}")


def require_on_grid(df: DataFrame, minutes: int = GRID_MINUTES) -> None:
    """For parsed, unfloored rows."""
    found = off_grid_times(df, minutes=minutes).first()
    if found["violations"]:
        raise AlignmentError(f"{found['violations']} times off the grid of {minutes} minutes")


def require_bounds(df: DataFrame, columns: Sequence[str] = IRRADIANCE) -> None:
    """Abort on the first column out of its range."""
    require_clean_bounds(irradiance_bounds(df, columns).collect(), columns)


def require_clean_bounds(report: Sequence[Row], columns: Sequence[str] = IRRADIANCE) -> None:
    """The same from the rows of a report that has the bounds among its checks."""
    found = {r["column"]: r for r in report if r["check"] == "bounds"}
    for c in columns:
        bad = found[c]
        if bad["violations"]:
            raise BoundsError(
                f"{c}: {bad['violations']} values out of range, from {bad['min_value']} to {bad['max_value']}"
            )
