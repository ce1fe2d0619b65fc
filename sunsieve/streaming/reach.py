"""How far a late reading reaches: which days of which stations cleaning changes, and what it must read for them.

Everything is found from one row per station and day: how many rows, and how many known values of
each column. Two things carry a change to other days: the outlier filter, over a few rows, and gap
filling, over nulls as far as the next known value.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sunsieve.schema import DAY, HAMPEL_WINDOW, MEASURES, STATION

#: Rows to either side that the outlier filter looks at: a median of deviations from medians.
REACH = 2 * (HAMPEL_WINDOW // 2)


def _up(last: int) -> WindowSpec:
    """The station's days from the first up to `last` rows from this one; a day without a date comes first."""
    return Window.partitionBy(STATION).orderBy(F.asc_nulls_first(DAY)).rowsBetween(Window.unboundedPreceding, last)


def _down(last: int) -> WindowSpec:
    """The same from the last day backwards."""
    return Window.partitionBy(STATION).orderBy(F.desc_nulls_last(DAY)).rowsBetween(Window.unboundedPreceding, last)


def day_summaries(rows: DataFrame) -> DataFrame:
    """(station_id, day, n, known_*): rows and known values of each measure, a row per station and day."""
    known = (F.count(c).alias(f"known_{c}") for c in MEASURES if c in rows.columns)
    return rows.groupBy(STATION, DAY).agg(F.count("*").alias("n"), *known)


def _and_near(flag: str) -> Column:
    """Where the flag is set, or within reach of a day where it is, in rows."""
    past = F.max(F.when(F.col(flag), F.col("end"))).over(_up(-1))
    ahead = F.min(F.when(F.col(flag), F.col("start"))).over(_down(-1))
    return F.col(flag) | F.coalesce(F.col("start") - past < REACH, F.lit(False)) | F.coalesce(ahead - F.col("end") < REACH, F.lit(False))


def changed_units(summaries: DataFrame, touched: DataFrame) -> DataFrame:
    """(station_id, day, changed, read) of every station and day, given the days that readings arrived for.

    `changed` ones may get other values. A day with nulls is changed if no known value lies
    between it and a touched day, or one within the outlier filter's reach of that. `read` ones
    have to be at hand for these: up to the nearest known values on both sides, all days between,
    since filling counts rows, and the filter's reach beyond.
    """
    columns = [c.removeprefix("known_") for c in summaries.columns if c.startswith("known_")]
    days = touched.select(F.col(DAY).alias("_day"), F.lit(True).alias("_hit")).distinct()
    units = summaries.join(days, F.col(DAY).eqNullSafe(F.col("_day")), "left").drop("_day")
    end = F.sum("n").over(_up(0))
    units = units.select(
        "*", F.coalesce("_hit", F.lit(False)).alias("touched"), F.row_number().over(_up(0)).alias("i"), end.alias("end"), (end - F.col("n")).alias("start")
    ).drop("_hit")
    units = units.withColumn("near", _and_near("touched"))
    here = {"last": F.max(F.when(F.col("near"), F.col("i"))).over(_up(-1))}
    here["next"] = F.min(F.when(F.col("near"), F.col("i"))).over(_down(-1))
    for c in columns:
        known = F.when(F.col(f"known_{c}") > 0, F.col("i"))
        here[f"last_{c}"], here[f"next_{c}"] = F.max(known).over(_up(-1)), F.min(known).over(_down(-1))
    units = units.select("*", *(x.alias(f"_{name}") for name, x in here.items()))

    def or_false(x: Column) -> Column:
        return F.coalesce(x, F.lit(False))

    def reached(c: str) -> Column:
        from_past = F.col("_last").isNotNull() & (F.col(f"_last_{c}").isNull() | (F.col(f"_last_{c}") <= F.col("_last")))
        from_ahead = F.col("_next").isNotNull() & (F.col(f"_next_{c}").isNull() | (F.col(f"_next_{c}") >= F.col("_next")))
        return (F.col("n") > F.col(f"known_{c}")) & (or_false(from_past) | or_false(from_ahead))

    changed = reduce(lambda a, b: a | b, map(reached, columns), F.col("near"))
    units = units.withColumn("changed", changed)
    # Where the nulls of a changed day find their known values; no such value, nothing to look for.
    gap = {c: F.col("changed") & (F.col("n") > F.col(f"known_{c}")) for c in columns}
    low = F.least(F.col("i"), F.col("i"), *(F.when(gap[c], F.col(f"_last_{c}")) for c in columns))
    high = F.greatest(F.col("i"), F.col("i"), *(F.when(gap[c], F.col(f"_next_{c}")) for c in columns))
    units = units.select(STATION, DAY, "i", "start", "end", "changed", low.alias("low"), high.alias("high"))
    inside = or_false(F.min(F.when(F.col("changed"), F.col("low"))).over(_down(0)) <= F.col("i"))
    inside |= or_false(F.max(F.when(F.col("changed"), F.col("high"))).over(_up(0)) >= F.col("i"))
    units = units.withColumn("inside", inside)
    return units.select(STATION, DAY, "changed", _and_near("inside").alias("read"))
