"""Rolling median, rolling deviation and the outlier filter built on them.

Centred windows by row position within a station, partial at the ends, nulls
skipped. The deviation is a median of deviations, so a row sees twice half a
window to either side. Wide windows are slid over, see `wide`.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.functions.values import middle
from sunsieve.operators.series import KEYS, by_chunk, in_order, with_nearby
from sunsieve.operators.wide import WIDE, wide_medians
from sunsieve.schema import HAMPEL_FACTOR, HAMPEL_THRESHOLD, HAMPEL_WINDOW, MAD_FLOOR, WIND


def _half(window: int) -> int:
    if window < 1 or window % 2 == 0:
        raise ValueError("the window must be an odd number of rows")
    return window // 2


def _frame(df: DataFrame, columns: Sequence[str], half: int) -> str:
    by = ", ".join(f"`{c}`" for c in in_order(df, columns))
    return f"PARTITION BY {', '.join(KEYS)} ORDER BY {by} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING"


def _medians(df: DataFrame, names: dict[str, str], frame: str) -> DataFrame:
    """Add a column with the median over the frame for each given name: column.

    A frame holds a few values, so gathering and sorting them beats a percentile.
    """
    gathered = (f"sort_array(collect_list(`{c}`) OVER ({frame})) AS `{name}_in`" for name, c in names.items())
    kept = [f"`{c}`" for c in df.columns]
    return df.selectExpr(*kept, *gathered).selectExpr(
        *kept, *(f"{middle(f'{name}_in')} AS `{name}`" for name in names)
    )


@by_chunk
def rolling_median(
    df: DataFrame, columns: Sequence[str], window: int = HAMPEL_WINDOW, suffix: str = "_median"
) -> DataFrame:
    """Add the rolling median of each column."""
    half = _half(window)
    if window >= WIDE:
        found = wide_medians(df, columns, window, deviations=False)
        return found.withColumnsRenamed({f"_med_{c}": c + suffix for c in columns})
    rows = with_nearby(df, columns, half, half)
    found = _medians(rows, {c + suffix: c for c in columns}, _frame(df, columns, half))
    return found.where(~F.col("_nearby")).drop("_nearby")


def _deviations(df: DataFrame, columns: Sequence[str], window: int) -> DataFrame:
    """Add `_med_*`, `_dev_*` and `_mad_*` for each column."""
    half = _half(window)
    if window >= WIDE:
        return wide_medians(df, columns, window, deviations=True)
    rows = with_nearby(df, columns, 2 * half, 2 * half)
    frame = _frame(df, columns, half)
    rows = _medians(rows, {f"_med_{c}": c for c in columns}, frame)
    rows = rows.selectExpr("*", *(f"abs(`{c}` - `_med_{c}`) AS `_dev_{c}`" for c in columns))
    return _medians(rows, {f"_mad_{c}": f"_dev_{c}" for c in columns}, frame).where(~F.col("_nearby"))


def _floored(c: str) -> str:
    return f"greatest(`_mad_{c}`, {MAD_FLOOR!r}D)"


@by_chunk
def rolling_mad(
    df: DataFrame, columns: Sequence[str], window: int = HAMPEL_WINDOW, suffix: str = "_mad"
) -> DataFrame:
    """Add the rolling median of the deviations from the rolling median, floored."""
    rows = _deviations(df, columns, window)
    return rows.selectExpr(*(f"`{c}`" for c in df.columns), *(f"{_floored(c)} AS `{c}{suffix}`" for c in columns))


@by_chunk
def hampel(
    df: DataFrame,
    columns: Sequence[str] = WIND,
    window: int = HAMPEL_WINDOW,
    threshold: float = HAMPEL_THRESHOLD,
    flag_prefix: str | None = None,
) -> DataFrame:
    """Replace outliers by the rolling median. A null stays null.

    With a flag prefix a boolean column per filtered column tells what was replaced.
    """
    rows = _deviations(df, columns, window)
    limit = threshold * HAMPEL_FACTOR
    is_outlier = {c: f"`_dev_{c}` > {limit!r}D * {_floored(c)}" for c in columns}

    def kept(c: str) -> str:
        return f"CASE WHEN {is_outlier[c]} THEN `_med_{c}` ELSE `{c}` END AS `{c}`" if c in is_outlier else f"`{c}`"

    flags = [] if flag_prefix is None else [
        f"coalesce({is_outlier[c]}, false) AS `{flag_prefix}{c}`" for c in columns
    ]
    return rows.selectExpr(*(kept(c) for c in df.columns), *flags)
