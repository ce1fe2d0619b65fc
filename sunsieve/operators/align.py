"""From raw text columns to typed readings on the grid, and the join of two feeds."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.errors import TransformError
from sunsieve.functions.grid import floor_to_grid, parse_time
from sunsieve.functions.values import blank_tokens, to_station
from sunsieve.operators.series import CHUNK_DAYS, KEYS, along_series, cut, per_piece
from sunsieve.schema import DELTAS, FINAL_TYPES, GRID_MINUTES, MEASURES, STATION, TIME, TIME_FORMAT


def need(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise TransformError(f"missing columns: {missing}")


def blank_null_tokens(df: DataFrame) -> DataFrame:
    """Null out the missing-value texts in every text column."""
    return df.withColumns({c: blank_tokens(F.col(c)) for c, t in df.dtypes if t == "string"})


def typed(df: DataFrame, fmt: str = TIME_FORMAT) -> DataFrame:
    """Parse the time (not floored yet) and cast measures and station; by name."""
    need(df, [TIME, STATION, *MEASURES])
    return df.withColumns(
        {
            TIME: parse_time(F.col(TIME), fmt),
            STATION: to_station(F.col(STATION)),
            **{c: F.col(c).cast("double") for c in MEASURES},
        }
    )


def on_grid(df: DataFrame, minutes: int = GRID_MINUTES) -> DataFrame:
    """Floor the time to the grid; the remainder is lost."""
    return df.withColumn(TIME, floor_to_grid(F.col(TIME), minutes))


def with_deltas(df: DataFrame) -> DataFrame:
    """Forecast minus measurement for the pairs that share a quantity."""
    return df.withColumns({name: F.col(nwp) - F.col(lmd) for name, (nwp, lmd) in DELTAS.items()})


def enforce_schema(df: DataFrame) -> DataFrame:
    """The final columns, types and order; extra columns go, missing ones are an error."""
    need(df, list(FINAL_TYPES))
    return df.select(
        *(
            (to_station(F.col(c)) if c == STATION else F.col(c).cast(t)).alias(c)
            for c, t in FINAL_TYPES.items()
        )
    )


def one_per_cell(df: DataFrame) -> DataFrame:
    """The rows, or an error while running if a station has two in one cell.

    Copies meet in a grouping, partly before the shuffle, so they never multiply in
    a join; the join on the same keys needs no further shuffle.
    """
    rest = [c for c in df.columns if c not in (STATION, TIME)]
    cells = df.groupBy(STATION, TIME).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in rest))
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("rows of one station share the time "), F.col(TIME).cast("string")))
    )
    return cells.where(single).select(*df.columns)


def align_join(
    forecast: DataFrame, measured: DataFrame, how: str = "inner", minutes: int = GRID_MINUTES
) -> DataFrame:
    """Join two feeds on station and grid cell. Sides must not share other columns.

    Which side to broadcast, if any, is left to the sizes Spark measures.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError("how must be inner, left or full")
    left, right = (one_per_cell(on_grid(side, minutes)) for side in (forecast, measured))
    return left.join(right, [STATION, TIME], how)


def align_join_asof(
    forecast: DataFrame, measured: DataFrame, tolerance_minutes: int, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Each forecast with the nearest measurement of its station at or before it, within a tolerance.

    Adds `measured_at` and the measured columns, null where no measurement is near enough. Sides
    must not share other columns; measurements must be unique per station and time, forecasts need
    not. Forecasts without a time find nothing, and measurements without one are not found; rows
    without a station are one series.

    Both feeds are merged into one series of pieces and each row looks back inside its piece; the
    last measurement before a piece comes from a scan over one row per piece.
    """
    names = [c for c in measured.columns if c not in (STATION, TIME)]
    reading = F.struct(F.col(TIME).alias("measured_at"), *names).alias("_reading")
    found = one_per_cell(measured.where(F.col(TIME).isNotNull())).select(STATION, TIME, reading, F.lit(0).alias("_side"))
    asked = forecast.withColumn("_side", F.lit(1))
    rows = cut(asked.unionByName(found, allowMissingColumns=True), chunk_days)
    pieces = rows.groupBy(*KEYS).agg(F.max_by("_reading", F.when(F.col("_side") == 0, F.col(TIME))).alias("_last"))
    before = F.last("_last", ignorenulls=True).over(along_series().rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(*KEYS, before.alias("_before"))
    up_to_here = per_piece([TIME, "_side"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_inside", F.last("_reading", ignorenulls=True).over(up_to_here)).where("_side = 1")
    rows = rows.join(pieces, list(KEYS)).withColumn("_found", F.coalesce("_inside", "_before"))
    near = F.col(TIME) - F.col("_found.measured_at") <= F.make_dt_interval(F.lit(0), F.lit(0), F.lit(tolerance_minutes))
    kept = F.when(near, F.col("_found"))
    return rows.select(*forecast.columns, *(kept.getField(c).alias(c) for c in ("measured_at", *names)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; their columns must have the same names and types."""
    first, *rest = frames
    for other in rest:
        if sorted(other.dtypes) != sorted(first.dtypes):
            raise TransformError(f"schemas differ: {first.dtypes} and {other.dtypes}")
        first = first.unionByName(other)
    return first
