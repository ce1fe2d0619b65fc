"""Mixing sources to target weights by entropy balancing, in built-in columns alone.

Of all document rates between 0 and the most copies allowed whose words add up to their source's
target, the ones closest to one copy each (in relative entropy) are exp(rate * size) with one rate
per source, cut at that most. The rates are the maximum of a concave dual, found by Newton steps
kept between known bounds: each step is one aggregation over all documents. A document's rate
depends on its source and size alone, so documents of one source and size are a cell, and the steps
run over the counts of cells.

Rates are rounded into copies cell by cell. The longest documents' cells are rounded one after the
other, each taking on the words that those before it were short of; the many shorter ones by a
running sum of copies, which is never off by a whole copy.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import maybe_broadcast, numbered, text_of
from sunsieve.sources.shared import landed

WORD = r"[^\x20\x09-\x0D]+"
#: Shares of the sources in order, repeating; words taken of all words; most copies of a document.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Newton steps at most, and the part of a target that may be missed by the rates.
STEPS, CLOSE = 200, 1e-10
#: Cells of a source that are rounded one after the other, the longest documents first.
HEAD = 1_000
#: Documents of a cell that one task puts in order.
SLICE_ROWS = 20_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the whole text; none in a null one) and an order of equals."""
    words = F.regexp_count(text_of(), F.lit(WORD)).cast("long")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"), words.alias("size"), F.xxhash64(doc_id).alias("by")
    )


def _same(left: str, right: str = "source_") -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The sources (source, source_size, ...) with `target`.

    Sources in order of code points, null last, weigh `weights`, repeating, and share `share` of all
    words by weight. A target stops at `most` times its source's words; what is above is shared
    among the others, until none is above: all others then stand at one level per weight.
    """
    place = numbered(sources.select("source"), [F.asc_nulls_last("source")])
    of = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    place = place.select(F.col("source").alias("source_"), of.cast("long").alias("weight"))
    known = landed(sources.join(place, _same("source")).drop("source_"), "weighed")
    total = share * (known.agg(F.sum("source_size").alias("n")).first().n or 0)
    bound, level, stopped = F.col("source_size") * most, None, -1
    while True:
        # Sources at their bound at this level; the level only rises, and with it their number.
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= bound
        at = known.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, bound)).alias("words"), F.sum(F.when(~full, F.col("weight"))).alias("weight")
        ).first()
        if at.n == stopped or not at.weight:
            break
        stopped, level = at.n, (total - (at.words or 0)) / at.weight
    target = F.least(F.col("weight") * F.lit(level or 0.0), bound.cast("double"))
    return known.withColumn("target", target)


def _rate(most: int) -> Column:
    return F.least(F.exp(F.col("tilt") * F.col("size") / F.col("mean")), F.lit(float(most)))


def tilts(spark: SparkSession, cells: DataFrame, sources: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """(source, tilt): one number per source, at which its cells' rates take its target.

    `cells` holds (source, size, n) and `sources` (source, target, source_size, mean, least), the
    mean and least size above none. Newton's step is taken where it stays between the bounds known
    so far, and their middle otherwise. Sources at their bound have an infinite tilt; sources
    without words have none.
    """
    words, target = F.col("source_size"), F.col("target")
    full = target >= most * words
    # At these tilts all rates are too low, or all at their bound.
    low = F.least(F.log(target / words) * F.col("mean") / F.col("least"), F.lit(0.0))
    high = F.log(F.lit(float(most))) * F.col("mean") / F.col("least")
    state = sources.where(words > 0).select(
        "source", "target", "source_size", "mean", F.when(full, F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("tilt"),
        low.alias("low"), high.alias("high"), full.alias("done"),
    )
    state, n = landed(state, "tilts"), sources.count()
    for _ in range(steps):
        if state.where(~F.col("done")).isEmpty():
            return state.select("source", "tilt")
        now = state.where(~F.col("done")).select(F.col("source").alias("source_"), "tilt", "mean")
        rate, weight = _rate(most), F.col("n") * F.col("size")
        slope = F.when(rate < most, weight * rate * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = cells.join(maybe_broadcast(now, n), _same("source")).groupBy("source_")
        sums = sums.agg(F.sum(weight * rate).alias("taken"), F.sum(slope).alias("slope"))
        state = state.join(maybe_broadcast(sums, n), _same("source"), "left").drop("source_")
        over = F.col("taken") - target
        low, high = F.when(over < 0, F.col("tilt")).otherwise(F.col("low")), F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        state = state.withColumns({"over": over, "low": low, "high": high})
        step = F.col("tilt") - F.try_divide("over", "slope")
        inside = (F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high"))
        near = F.col("done") | (F.abs("over") <= CLOSE * target) | (F.col("high") - F.col("low") <= 1e-14 * F.abs("high"))
        moved = F.when(near, F.col("tilt")).when(inside, step).otherwise((F.col("low") + F.col("high")) / 2)
        state = state.withColumns({"tilt": moved, "done": near}).drop("taken", "slope", "over")
        state = landed(state, "tilts")
    raise RuntimeError(f"rates did not settle in {steps} steps")


def _rounded(cells: DataFrame, most: int, head: int) -> DataFrame:
    """The cells (source, size, n, rate) with `copies`, how many copies their documents have together.

    A cell's copies lie between none and `most` each. No more than `head` cells of a source are
    gathered in one value.
    """
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    cells = cells.withColumn("at", F.row_number().over(down))
    cell = F.struct("size", "n", "rate")
    first = cells.where(F.col("at") <= head).groupBy("source").agg(F.reverse(F.sort_array(F.collect_list(cell))).alias("cells"))

    def one_more(done: Column, c: Column) -> Column:
        wanted = c["n"] * c["rate"] + done["short"] / c["size"]
        copies = F.least(F.greatest(F.round(wanted), F.lit(0.0)), (c["n"] * most).cast("double"))
        short = (wanted - copies) * c["size"]
        return F.struct(short.alias("short"), F.concat(done["copies"], F.array(copies.cast("long"))).alias("copies"))

    nothing = F.struct(F.lit(0.0).alias("short"), F.array().cast("array<long>").alias("copies"))
    first = first.select("source", "cells", F.aggregate("cells", nothing, one_more)["copies"].alias("copies"))
    first = first.select("source", F.inline(F.arrays_zip("cells", "copies")))
    first = first.select("source", F.col("cells.size").alias("size"), F.col("cells.n").alias("n"), "cells.rate", "copies")
    # Shorter ones: whole copies of a running sum, so that all documents up to any size are right to one copy.
    up_to = F.sum(F.col("n") * F.col("rate")).over(down.rowsBetween(Window.unboundedPreceding, 0))
    rest = cells.where(F.col("at") > head).withColumn("to", F.floor(up_to + 0.5))
    copies = F.col("to") - F.coalesce(F.lag("to").over(down), F.lit(0))
    return first.union(rest.select("source", "size", "n", "rate", F.least(copies, F.col("n") * most)))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, head: int = HEAD, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken: how often the mix takes each document.

    Sources share `share` of all words by their weights (see `targets`); a document is taken
    between 0 and `most` times, `taken` is its size times its copies. Sizes are words of the whole
    text, none in a null one; documents without words have rate 1 and one copy, and a source that
    has no others has target 0. Rows of a null source are one source, the last. Repeated rows are
    documents of their own, a null doc_id is kept, an empty table gives no rows, and other columns
    are not read. Which documents of equal source and size get a copy more follows from a hash of
    doc_id, so every run takes the same.

    Documents are put in order in slices of a cell, so no task holds a large group of equal ones;
    a source's cells are at most as many as the sizes that its documents have.
    """
    spark = docs.sparkSession
    rows = landed(sized(docs), "sized")
    cells = landed(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    size, n = F.col("size"), F.col("n")
    some = F.when(size > 0, n)
    sources = cells.groupBy("source").agg(
        F.sum(size * n).alias("source_size"), (F.sum(size * n) / F.sum(some)).alias("mean"), F.min(F.when(size > 0, size)).alias("least")
    )
    sources = landed(targets(sources, weights, share, most), "sources")
    n_sources = sources.count()
    found = tilts(spark, cells.where(size > 0), sources, most)
    # Sums of doubles may end differently in another run; six decimals of the tilt do not.
    found = found.select(F.col("source").alias("source_"), F.round("tilt", 6).alias("tilt"))
    known = sources.select("source", "source_size", "target", "mean").join(found, _same("source"), "left").drop("source_")
    known = landed(known, "tilted")
    of = known.select(F.col("source").alias("source_"), "tilt", "mean")
    worded = cells.where(size > 0).join(maybe_broadcast(of, n_sources), _same("source"))
    plan = _rounded(worded.select("source", "size", "n", _rate(most).alias("rate")), most, head)
    # `each` copies for all of a cell, one more for the first `more` of it.
    each = F.floor(F.col("copies") / n)
    plan = plan.select(
        F.col("source").alias("source_"), F.col("size").alias("size_"), "rate", each.alias("each"), (F.col("copies") - each * n).alias("more"),
        F.ceil(n / slice_rows).alias("slices"),
    )
    plan = landed(plan, "plan")
    here = _same("source") & (size == F.col("size_"))
    rows = rows.join(maybe_broadcast(plan, plan.count()), here, "left").drop("source_", "size_")
    rows = rows.withColumn("slice", F.pmod("by", F.coalesce("slices", F.lit(1))))
    # Cells of which some documents have a copy more: their slices one after the other, by a row per slice.
    chosen = rows.where("more > 0")
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = chosen.groupBy("source", "size", "slice").agg(F.count("*").alias("m"))
    starts = starts.select(
        F.col("source").alias("source_"), F.col("size").alias("size_"), F.col("slice").alias("slice_"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("begin")
    )
    within = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("by", "doc_id"))
    chosen = chosen.withColumn("within", within).join(starts, here & (F.col("slice") == F.col("slice_")))
    chosen = chosen.withColumn("each", F.col("each") + (F.col("begin") + F.col("within") <= F.col("more")).cast("long"))
    columns = ["doc_id", "source", "size", "rate", "each"]
    dealt = rows.where("more IS NULL OR more = 0").select(columns).union(chosen.select(columns))
    whole = known.select(F.col("source").alias("source_"), "source_size", "target")
    dealt = dealt.join(maybe_broadcast(whole, n_sources), _same("source")).drop("source_")
    copies = F.coalesce("each", F.lit(1)).cast("long")
    return dealt.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("rate", F.lit(1.0)).alias("rate"), copies.alias("copies"), (size * copies).alias("taken")
    )
