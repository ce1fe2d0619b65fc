"""Medians over wide windows: order statistics that are kept as the window slides.

Gathering and sorting every row's window costs its width times the rows. Here a piece's rows, with
those around it, come to a task in order of time; one sorted list takes in the row that enters the
window and lets go of the one that leaves it.

The rows around a piece are found by position. From one row per piece it is known which pieces hold
them, so each row goes only to the pieces that ask for it, however short or long pieces are.
"""

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sunsieve.operators.series import CHUNK, KEYS, SERIES, along_series, per_piece
from sunsieve.schema import TIME

#: Windows from this many rows on are slid over; narrower ones are gathered by Spark.
WIDE = 65


def sliding_median(values: np.ndarray, half: int) -> np.ndarray:
    """Centred medians of 2 * half + 1 values, partial at the ends; NaN stands for null and is skipped."""
    out, window = np.full(len(values), np.nan), []
    listed = values.tolist()
    for at in range(-half, len(listed)):
        if (new := at + half) < len(listed) and listed[new] == listed[new]:
            insort(window, listed[new])
        if (old := at - half - 1) >= 0 and listed[old] == listed[old]:
            del window[bisect_left(window, listed[old])]
        if at >= 0 and (n := len(window)):
            out[at] = (window[(n - 1) // 2] + window[n // 2]) / 2
    return out


def _asked(rows: DataFrame, reach: int) -> DataFrame:
    """(keys of a piece, chunk that asks for some of its rows, first and last place asked for); places count along the series."""
    pieces = rows.groupBy(*KEYS).agg(F.count("*").alias("_n"))
    end = F.sum("_n").over(along_series().rowsBetween(Window.unboundedPreceding, 0))
    pieces = pieces.select(*KEYS, (end - F.col("_n")).alias("_start"), end.alias("_end"), F.row_number().over(along_series()).alias("_i"))
    # The first piece that reaches into the rows before, the last that reaches into those behind.
    back = Window.partitionBy(SERIES).orderBy("_end").rangeBetween(-(reach - 1), 0)
    ahead = Window.partitionBy(SERIES).orderBy("_start").rangeBetween(0, reach - 1)
    pieces = pieces.select("*", F.min("_i").over(back).alias("_first"), F.max("_i").over(ahead).alias("_last"))
    first = F.coalesce(F.lag("_first").over(along_series()), F.col("_i"))
    last = F.coalesce(F.lead("_last").over(along_series()), F.col("_i"))
    pieces = pieces.select("*", first.alias("_from_piece"), last.alias("_to_piece"))
    asks = pieces.select(
        SERIES, F.col(CHUNK).alias("_asks"), F.col("_i").alias("_own"), F.explode(F.sequence("_from_piece", "_to_piece")).alias("_i"),
        (F.col("_start") - reach).alias("_from"), (F.col("_end") + reach).alias("_to"),
    ).where("_i <> _own")
    return asks.join(pieces.select(SERIES, "_i", CHUNK, "_start"), [SERIES, "_i"]).drop("_i", "_own")


def with_around(df: DataFrame, columns: Sequence[str], reach: int) -> DataFrame:
    """The rows of every piece and those within `reach` rows of it, told apart by `_nearby`."""
    place = F.row_number().over(per_piece([TIME])) - 1
    narrow = df.select(*KEYS, TIME, *columns).withColumn("_at", place).join(_asked(df, reach), list(KEYS))
    at = F.col("_start") + F.col("_at")
    near = narrow.where((at >= F.col("_from")) & (at < F.col("_to"))).drop(CHUNK).withColumnRenamed("_asks", CHUNK)
    near = near.select(*KEYS, TIME, *columns, F.lit(True).alias("_nearby"))
    return df.withColumn("_nearby", F.lit(False)).unionByName(near, allowMissingColumns=True)


def wide_medians(df: DataFrame, columns: Sequence[str], window: int, deviations: bool) -> DataFrame:
    """The rows with `_med_*` of each column, and with `_dev_*` and `_mad_*`, the medians of the deviations, if asked for."""
    half, names = window // 2, df.columns
    added = [f"{p}{c}" for c in columns for p in (("_med_", "_dev_", "_mad_") if deviations else ("_med_",))]
    rows = with_around(df, columns, 2 * half if deviations else half)

    def slide(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[(TIME, "ascending")], null_placement="at_start"))
        own = pc.invert(table.column("_nearby"))
        found = {}
        for c in columns:
            x = table.column(c).combine_chunks().cast(pa.float64())
            missing = np.asarray(pc.is_null(x))
            # A measured NaN is no null: it sorts above all numbers, as it does elsewhere.
            y = x.to_numpy(zero_copy_only=False)
            y = np.where(missing, np.nan, np.where(np.isnan(y), np.inf, y))
            parts = {"_med_": sliding_median(y, half)}
            if deviations:
                parts["_dev_"] = np.abs(y - parts["_med_"])
                parts["_mad_"] = sliding_median(parts["_dev_"], half)
            for p, v in parts.items():
                empty = np.isnan(v)
                found[f"{p}{c}"] = pa.array(np.where(np.isinf(v), np.nan, v), pa.float64(), mask=empty)
        whole = table.select(names)
        for name in added:
            whole = whole.append_column(name, found[name])
        return whole.filter(own)

    schema = StructType([*df.schema.fields, *(StructField(name, DoubleType()) for name in added)])
    return rows.groupBy(*KEYS).applyInArrow(slide, schema)
