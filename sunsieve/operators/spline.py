"""Gap filling by natural cubic splines along a series, solved piece by piece.

The curvatures of a spline at its known values are one tridiagonal system over the whole series.
A piece eliminates all but its first and last known value: every inner curvature is a fixed part
plus multiples of these two. What is left is a small system of two unknowns a piece, solved along
the series from one row per piece; each piece then puts its two curvatures, and the known values
next to it, back in.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sunsieve.operators.series import CHUNK, KEYS, SERIES, by_chunk
from sunsieve.schema import MEASURES, TIME

_EDGES = ("low", "high")
#: A piece and column: rows, known values, and at either edge place, value, step inwards, slope
#: inwards, and the curvature one step inwards as fixed part and multiples of both edges' own.
_SUMMARY = ["rows", "known", *(f"{e}_{x}" for e in _EDGES for x in ("at", "y", "step", "slope", "fixed", "of_low", "of_high"))]
#: What a piece is told of a column: both edges' curvatures, and the known values next to it.
_TOLD = ["low_curve", "high_curve", *(f"{e}_{x}" for e in ("before", "after") for x in ("at", "y", "curve"))]


def solve_tridiagonal(below: np.ndarray, middle: np.ndarray, above: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The solution for each column of `right`; the matrix must be diagonally dominant, as a spline's is."""
    n = len(middle)
    c, d = np.zeros(n), np.array(right, dtype=float)
    for i in range(n):
        pivot = middle[i] - (below[i] * c[i - 1] if i else 0.0)
        c[i] = above[i] / pivot
        d[i] = (d[i] - (below[i] * d[i - 1] if i else 0.0)) / pivot
    for i in range(n - 2, -1, -1):
        d[i] -= c[i] * d[i + 1]
    return d


def inner_curves(at: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Curvatures at all but the first and last known value: fixed part, multiples of the first's and the last's."""
    step, slope = np.diff(at), np.diff(y) / np.diff(at)
    n = len(at) - 2
    right = np.zeros((n, 3))
    right[:, 0] = 6 * np.diff(slope)
    right[0, 1] -= step[0]
    right[-1, 2] -= step[-1]
    below, above = step[:-1].copy(), step[1:].copy()
    below[0] = above[-1] = 0.0
    return solve_tridiagonal(below, 2 * (step[:-1] + step[1:]), above, right)


def summary(y: np.ndarray) -> list[float]:
    """A piece's column in one row, see `_SUMMARY`; places count from the piece's first row, NaN is null."""
    at = np.flatnonzero(~np.isnan(y))
    out = dict.fromkeys(_SUMMARY, np.nan) | {"rows": len(y), "known": len(at)}
    if len(at):
        out |= {"low_at": at[0], "low_y": y[at[0]], "high_at": at[-1], "high_y": y[at[-1]]}
    if len(at) > 1:
        step, slope = np.diff(at), np.diff(y[at]) / np.diff(at)
        # Next to an edge lies an inner value, or the other edge itself.
        low, high = np.array([0.0, 0.0, 1.0]), np.array([0.0, 1.0, 0.0])
        if len(at) > 2:
            curves = inner_curves(at, y[at])
            low, high = curves[0], curves[-1]
        for edge, k, next_to in (("low", 0, low), ("high", -1, high)):
            out |= {f"{edge}_step": step[k], f"{edge}_slope": slope[k]}
            out |= {f"{edge}_{x}": v for x, v in zip(("fixed", "of_low", "of_high"), next_to)}
    return [float(out[x]) for x in _SUMMARY]


def edge_curves(pieces: np.ndarray) -> np.ndarray:
    """What each piece of a series is told of a column (see `_TOLD`), from their rows in order (see `_SUMMARY`)."""
    col = {x: k for k, x in enumerate(_SUMMARY)}
    start = np.concatenate([[0.0], np.cumsum(pieces[:-1, col["rows"]])])
    # The edges that are left, in order: piece, which edge, place, value.
    edges = []
    for k, p in enumerate(pieces):
        if p[col["known"]] > 0:
            edges.append((k, "low", start[k] + p[col["low_at"]], p[col["low_y"]]))
        if p[col["known"]] > 1:
            edges.append((k, "high", start[k] + p[col["high_at"]], p[col["high_y"]]))
    n = len(edges)
    below, middle, above, right = np.zeros(n), np.ones(n), np.zeros(n), np.zeros(n)
    for i in range(1, n - 1):  # at both ends of the series the curvature is 0
        k, edge, at, y = edges[i]
        p, alone = pieces[k], pieces[k][col["known"]] == 1
        for side, other in ((-1, edges[i - 1]), (1, edges[i + 1])):
            inwards = not alone and side == (1 if edge == "low" else -1)
            if inwards:  # towards the piece's inner values
                step, slope = p[col[f"{edge}_step"]], p[col[f"{edge}_slope"]]
                fixed, own, far = p[col[f"{edge}_fixed"]], p[col[f"{edge}_of_{edge}"]], p[col[f"{edge}_of_{'high' if edge == 'low' else 'low'}"]]
            else:
                step = abs(other[2] - at)
                slope = (other[3] - y) / (other[2] - at)
                fixed, own, far = 0.0, 0.0, 1.0
            middle[i] += 2 * step + step * own - (1.0 if side == -1 else 0.0)
            right[i] += 6 * side * slope - step * fixed
            (below if side == -1 else above)[i] = step * far
    curve = solve_tridiagonal(below, middle, above, right) if n else np.zeros(0)
    told = np.full((len(pieces), len(_TOLD)), np.nan)
    place = {x: k for k, x in enumerate(_TOLD)}
    for (k, edge, _, _), c in zip(edges, curve):
        told[k, place[f"{edge}_curve"]] = c
        if pieces[k, col["known"]] == 1:
            told[k, place["high_curve"]] = c
    for name, found, order in (("before", None, range(len(pieces))), ("after", None, range(len(pieces) - 1, -1, -1))):
        by_piece = {}
        for i, (k, *_) in enumerate(edges):
            if name == "before" or k not in by_piece:
                by_piece[k] = i  # the last edge of a piece lies before what follows, the first after what precedes
        for k in order:
            if found is not None:
                _, _, at, y = edges[found]
                told[k, [place[f"{name}_{x}"] for x in ("at", "y", "curve")]] = at - start[k], y, curve[found]
            found = by_piece.get(k, found)
    return told


def filled(y: np.ndarray, told: Sequence[float]) -> np.ndarray:
    """The piece's column with its nulls on the spline; beyond the first and last known value of the series as these."""
    t = dict(zip(_TOLD, told))
    at = np.flatnonzero(~np.isnan(y)).astype(float)
    knots, values = at, y[~np.isnan(y)]
    curves = np.zeros(len(at))
    if len(at):
        curves[0], curves[-1] = t["low_curve"], t["high_curve"]
        if len(at) > 2:
            curves[1:-1] = inner_curves(at, values) @ [1.0, t["low_curve"], t["high_curve"]]
    if not np.isnan(t["before_at"]):
        knots, values, curves = (np.concatenate([[t[f"before_{x}"]], v]) for x, v in (("at", knots), ("y", values), ("curve", curves)))
    if not np.isnan(t["after_at"]):
        knots, values, curves = (np.concatenate([v, [t[f"after_{x}"]]]) for x, v in (("at", knots), ("y", values), ("curve", curves)))
    gaps = np.flatnonzero(np.isnan(y)).astype(float)
    out = y.copy()
    if not len(knots) or not len(gaps):
        return out
    right = np.searchsorted(knots, gaps)
    inside = (right > 0) & (right < len(knots))
    ends = np.where(right == 0, values[0], values[-1])
    r = np.where(inside, right, min(1, len(knots) - 1))
    low, high = r - 1, r
    if len(knots) > 1:
        step = knots[high] - knots[low]
        a, b = (knots[high] - gaps) / step, (gaps - knots[low]) / step
        on = a * values[low] + b * values[high] + ((a**3 - a) * curves[low] + (b**3 - b) * curves[high]) * step**2 / 6
        ends = np.where(inside, on, ends)
    out[gaps.astype(int)] = ends
    return out


def _values(table: pa.Table, c: str) -> np.ndarray:
    """Doubles with NaN for null; a NaN that was measured looks the same."""
    return table.column(c).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def _in_time(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[(TIME, "ascending")], null_placement="at_start"))


@by_chunk
def impute_spline(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Fill nulls on the natural cubic spline through the known values of each station, by row position.

    Before the first and after the last known value that value stands; a station without any stays
    null, and with one or two the spline is a constant or a line. What is known stays, measured NaN
    included; it gives the spline no value. Columns not in the frame are passed over.

    A task holds one piece at a time; the systems along the series have one row per piece.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    keys = ", ".join(f"{k} {t}" for k, t in df.select(*KEYS).dtypes)

    def sum_up(table: pa.Table) -> pa.Table:
        table = _in_time(table)
        found = np.array([summary(_values(table, c)) for c in columns])
        at = [pa.array([table.column(k)[0].as_py()] * len(columns), table.schema.field(k).type) for k in KEYS]
        return pa.table([*at, pa.array(columns), *map(pa.array, found.T)], names=[*KEYS, "column", *_SUMMARY])

    pieces = df.select(*KEYS, TIME, *columns).groupBy(*KEYS)
    pieces = pieces.applyInArrow(sum_up, f"{keys}, column string, " + ", ".join(f"{x} double" for x in _SUMMARY))

    def along(table: pa.Table) -> pa.Table:
        table = table.sort_by(CHUNK)
        told = edge_curves(np.column_stack([table.column(x).to_numpy() for x in _SUMMARY]))
        kept = [table.column(x) for x in (*KEYS, "column")]
        return pa.table([*kept, *map(pa.array, told.T)], names=[*KEYS, "column", *_TOLD])

    told = pieces.groupBy(SERIES, "column").applyInArrow(along, f"{keys}, column string, " + ", ".join(f"{x} double" for x in _TOLD))

    def put_in(rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = _in_time(rows)
        of = {r["column"]: [r[x] for x in _TOLD] for r in told.to_pylist()}
        for c in columns:
            y = filled(_values(rows, c), of[c])
            column = rows.column(c)
            known = pa.chunked_array([pa.array(y, pa.float64(), mask=np.isnan(y))])
            kept = pc.if_else(pc.is_valid(column), column, known.cast(column.type))
            rows = rows.set_column(rows.schema.get_field_index(c), rows.schema.field(c), kept)
        return rows

    return df.groupBy(*KEYS).cogroup(told.groupBy(*KEYS)).applyInArrow(put_in, df.schema)
