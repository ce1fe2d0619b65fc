"""Series cut into bounded pieces, and what each piece must know of the others.

A window over a whole station would put the station into one task. Here a series
is cut by value into pieces of `chunk_days` days, so a piece of a grid of
g minutes holds at most chunk_days * 1440 / g rows however long the series is
and however much of the data one station owns. Two small tables then make the
pieces exact:

* `nearby_rows`: the k rows just outside a piece, however far away in time, for
  frames of fixed reach;
* a summary row per piece, scanned along the series, for values of unbounded
  reach (see `impute`).

Only these tables are ever windowed by station, one row per piece: a station has
about 114 pieces per ten years.

Finer grids want shorter pieces, sparser series longer ones.

Rows must be unique per station and time (`checks.duplicate_keys`). Rows without
a time form one piece that sorts first; rows without a station form one series.
"""

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sunsieve.schema import MEASURES, STATION, TIME

SERIES = "_series"
CHUNK = "_chunk"
KEYS = (SERIES, CHUNK)
CHUNK_DAYS = 32

# Valid stations are 0..255 and valid days lie far above, so these stand for null.
NO_STATION = -1
NO_TIME = -(2**31)


def cut(df: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Add the piece keys. Steps that find them keep the partitioning they imply."""
    if chunk_days < 1:
        raise ValueError("chunk_days must be at least 1")
    day = F.unix_date(F.col(TIME).cast("date"))
    return df.withColumns(
        {
            SERIES: F.coalesce(F.col(STATION), F.lit(NO_STATION)),
            CHUNK: F.coalesce(day - F.pmod(day, F.lit(chunk_days)), F.lit(NO_TIME)),
        }
    )


def by_chunk(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let a step that needs pieces run on whole series too."""

    @wraps(step)
    def run(df: DataFrame, *args, chunk_days: int = CHUNK_DAYS, **kwargs) -> DataFrame:
        if CHUNK in df.columns:
            return step(df, *args, **kwargs)
        return step(cut(df, chunk_days), *args, **kwargs).drop(*KEYS)

    run.keeps_keys = True
    return run


def in_order(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Sort columns of a piece: the time, then whatever the step leaves alone.

    The ties are settled by data, so a task that runs again gives the same rows,
    and every branch of a plan asks for the same columns and shares one shuffle.
    Measures come last: the order of a step on all of them is then the start of the
    order of a step on some, and following steps need no new sort.
    """
    rest = [c for c in df.columns if c not in (TIME, *KEYS, *columns)]
    return [TIME, *sorted(rest, key=lambda c: c in MEASURES)]


def per_piece(order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*KEYS).orderBy(*order)


def along_series() -> WindowSpec:
    """For tables with one row per piece only."""
    return Window.partitionBy(SERIES).orderBy(CHUNK)


def _edge(df: DataFrame, columns: Sequence[str], k: int, name: str, newest: bool) -> DataFrame:
    time = F.col(TIME)
    rank = F.row_number().over(per_piece([time.desc() if newest else time.asc()]))
    # `rank <= k` is applied before the shuffle too, so about k rows per piece travel.
    nearest = df.select(*KEYS, TIME, *columns).withColumn("_rank", rank).where(F.col("_rank") <= k)
    return nearest.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct(TIME, *columns))).alias(name))


def nearby_rows(df: DataFrame, columns: Sequence[str], before: int = 0, after: int = 0) -> DataFrame:
    """For each piece the last rows before it and the first rows after it.

    Every piece holds at least one row, so the k pieces next to it are enough.
    Gives the keys of the piece asking, the time and the given columns.
    """
    along = along_series()
    found = []
    edges = None
    if before:
        edges = _edge(df, columns, before, "_tail", newest=True)
        seen = F.flatten(F.collect_list("_tail").over(along.rowsBetween(-before, -1)))
        found.append(F.slice(seen, F.greatest(F.size(seen) - before, F.lit(0)) + 1, before))
    if after:
        heads = _edge(df, columns, after, "_head", newest=False)
        edges = heads if edges is None else edges.join(heads, list(KEYS))
        seen = F.flatten(F.collect_list("_head").over(along.rowsBetween(1, after)))
        found.append(F.slice(seen, 1, after))
    if edges is None:
        raise ValueError("ask for rows before, after or both")
    return edges.select(*KEYS, F.concat(*found).alias("_rows")).select(*KEYS, F.inline("_rows"))


def with_nearby(df: DataFrame, columns: Sequence[str], before: int = 0, after: int = 0) -> DataFrame:
    """The rows of every piece and its nearby rows, told apart by `_nearby`."""
    if not before and not after:
        return df.withColumn("_nearby", F.lit(False))
    nearby = nearby_rows(df, columns, before, after).withColumn("_nearby", F.lit(True))
    return df.withColumn("_nearby", F.lit(False)).unionByName(nearby, allowMissingColumns=True)
