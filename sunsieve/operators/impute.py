"""Gap filling by row position within a station.

A null needs the nearest value before and after it, at any distance. Inside a
piece windows find them. For the rest each piece is summed up in one row (how many
rows, first and last value of each column and where), these rows are scanned along
the series, and every piece is joined to what lies outside it. The piece keys
partition the windows, the summary and the join alike, so the readings are shuffled
once.

The expressions are SQL text: the same few repeat for every column.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.operators.series import CHUNK, KEYS, SERIES, by_chunk, in_order
from sunsieve.schema import MEASURES

# A scan ahead is a scan back over the opposite order: a frame to the far end
# would start anew at every row.
_TO_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_TO_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_PIECES_UP = f"PARTITION BY {SERIES} ORDER BY {CHUNK} {_TO_BEFORE}"
_PIECES_DOWN = f"PARTITION BY {SERIES} ORDER BY {CHUNK} DESC {_TO_BEFORE}"


def _rows_of(order: Sequence[str], direction: str) -> str:
    by = ", ".join(f"`{c}` {direction}" for c in order)
    return f"PARTITION BY {SERIES}, {CHUNK} ORDER BY {by}"


def _outside(rows: DataFrame, columns: Sequence[str], back: bool, ahead: bool) -> DataFrame:
    """One row per piece: the nearest values outside it and where they are.

    Positions count from the piece that asks: 0 is the row before its first.
    """
    parts = ["max(_pos) AS _rows"]
    for c in columns:
        at = f"CASE WHEN `{c}` IS NOT NULL THEN _pos END"
        if back:
            parts += [f"max_by(`{c}`, {at}) AS `_last_{c}`", f"max({at}) AS `_last_at_{c}`"]
        if ahead:
            parts += [f"min_by(`{c}`, {at}) AS `_first_{c}`", f"min({at}) AS `_first_at_{c}`"]
    pieces = rows.groupBy(*KEYS).agg(*map(F.expr, parts))
    pieces = pieces.selectExpr("*", f"coalesce(sum(_rows) OVER ({_PIECES_UP}), 0L) AS _start")

    def nearest(edge: str, c: str, window: str, name: str) -> list[str]:
        at = f"last(_start + `_{edge}_at_{c}`, true) OVER ({window}) - _start AS `_{name}_at_{c}`"
        return [at, f"last(`_{edge}_{c}`, true) OVER ({window}) AS `_{name}_{c}`"]

    found = [e for c in columns if back for e in nearest("last", c, _PIECES_UP, "before")]
    found += [e for c in columns if ahead for e in nearest("first", c, _PIECES_DOWN, "after")]
    return pieces.selectExpr(*KEYS, *found)


def _with_neighbours(df: DataFrame, columns: Sequence[str], back: bool, ahead: bool) -> DataFrame:
    """Add the row's position and the nearest values in and outside its piece."""
    order = in_order(df, columns)
    up, down = _rows_of(order, "ASC"), _rows_of(order, "DESC")
    rows = df.selectExpr("*", f"row_number() OVER ({up}) AS _pos")
    outside = _outside(rows, columns, back, ahead)

    def inside(c: str, window: str, name: str) -> list[str]:
        at = f"last(CASE WHEN `{c}` IS NOT NULL THEN _pos END, true)"
        return [
            f"{at} OVER ({window} {_TO_HERE}) AS `_{name}_at_{c}`",
            f"last(`{c}`, true) OVER ({window} {_TO_HERE}) AS `_{name}_{c}`",
        ]

    return rows.selectExpr(
        "*",
        *(e for c in columns if back for e in inside(c, up, "p")),
        *(e for c in columns if ahead for e in inside(c, down, "n")),
    ).join(outside, list(KEYS))


def _before(c: str) -> str:
    return f"coalesce(`_p_{c}`, `_before_{c}`)"


def _after(c: str) -> str:
    return f"coalesce(`_n_{c}`, `_after_{c}`)"


def _line(c: str) -> str:
    """Value on the line between the neighbours; null unless both exist."""
    low_at, high_at = f"coalesce(`_p_at_{c}`, `_before_at_{c}`)", f"coalesce(`_n_at_{c}`, `_after_at_{c}`)"
    slope = f"({_after(c)} - {_before(c)}) / ({high_at} - {low_at})"
    return f"CASE WHEN `{c}` IS NULL THEN {_before(c)} + (_pos - {low_at}) * ({slope}) END"


def _filled(df: DataFrame, columns: Sequence[str], *choices: Callable[[str], str]) -> DataFrame:
    """The first choice that has a value, for the nulls of each column."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    rows = _with_neighbours(df, columns, choices != (_after,), choices != (_before,))
    return rows.selectExpr(
        *(
            f"coalesce(`{c}`, {', '.join(choice(c) for choice in choices)}) AS `{c}`" if c in columns else f"`{c}`"
            for c in df.columns
        )
    )


@by_chunk
def interpolate(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Fill nulls that have values on both sides, linearly by row position."""
    return _filled(df, columns, _line)


@by_chunk
def forward_fill(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Fill nulls with the value before."""
    return _filled(df, columns, _before)


@by_chunk
def backward_fill(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Fill nulls with the value after."""
    return _filled(df, columns, _after)


@by_chunk
def impute(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Interpolate, then fill the end forward and the start backward.

    Columns not in the frame are passed over; a station without any value stays null.
    """
    return _filled(df, columns, _line, _before, _after)
