"""The ordered cleaning of a table of readings, as one lazy plan."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunsieve.errors import SieveError, TransformError
from sunsieve.operators.align import with_deltas
from sunsieve.operators.hampel import hampel
from sunsieve.operators.impute import impute
from sunsieve.operators.night import zero_at_night
from sunsieve.operators.series import CHUNK, CHUNK_DAYS, KEYS, cut
from sunsieve.functions.solar import is_night
from sunsieve.schema import DELTAS, MEASURES, TIME, WIND

Step = Callable[[DataFrame], DataFrame]

STEPS: tuple[Step, ...] = (zero_at_night, hampel, impute)


def _name(step: Step) -> str:
    return getattr(step, "__name__", type(step).__name__)


def _applied(rows: DataFrame, step: Step, run: Step, chunk_days: int) -> DataFrame:
    """The step's rows; those of this package find the piece keys, a caller's do not."""
    own = getattr(step, "keeps_keys", False)
    if own and CHUNK not in rows.columns:
        rows = cut(rows, chunk_days)
    elif not own:
        rows = rows.drop(*KEYS)
    try:
        return run(rows)
    except SieveError:
        raise
    except Exception as cause:
        raise TransformError(f"step {_name(step)} failed: {cause}") from cause


def _need_columns(step: Step, found: Sequence[str], wanted: Sequence[str]) -> None:
    found, wanted = ([c for c in x if c not in KEYS] for x in (found, wanted))
    if sorted(found) != sorted(wanted):
        raise TransformError(f"step {_name(step)} changed the columns from {wanted} to {found}")


def clean(
    df: DataFrame,
    steps: Sequence[Step] = STEPS,
    recompute_deltas: bool = False,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Apply the steps in order. Each must give back the columns it got.

    Steps may be any function of a frame. Those of this package leave time and station
    alone (`keeps_keys`): between them the frame also holds the piece keys, so that
    they share one shuffle. A caller's step does not see the keys, and may change time
    and station: the pieces are cut anew after it. Forecast errors stay as loaded
    unless asked for anew.
    """
    names = df.columns
    rows = df
    for step in steps:
        before = rows.columns
        rows = _applied(rows, step, step, chunk_days)
        _need_columns(step, rows.columns, before)
    rows = rows.select(*names)
    if recompute_deltas and set(DELTAS) <= set(names):
        rows = with_deltas(rows).select(*names)
    return rows


def _missing(df: DataFrame) -> Column:
    """How many measures of the row are null."""
    return sum((F.col(c).isNull().cast("int") for c in MEASURES if c in df.columns), F.lit(0))


def _dark(df: DataFrame, name: str) -> DataFrame:
    return zero_at_night(df).withColumn(name, F.coalesce(is_night(F.col(TIME)), F.lit(False)).cast("int"))


def _outliers(df: DataFrame, name: str) -> DataFrame:
    rows = hampel(df, flag_prefix=name)
    found = sum((F.col(name + c).cast("int") for c in WIND), F.lit(0))
    return rows.withColumn(name, found).drop(*(name + c for c in WIND))


#: Steps that tell what they changed: with a column of that, the cells a row has for it, and decimals of the percentage.
_TELLING = {zero_at_night: (_dark, 1, 1), hampel: (_outliers, len(WIND), 3)}

METRICS = (
    "position int, step string, rows_before long, rows_after long, nulls_before long, nulls_after long, "
    "changed long, changed_percent double"
)


def clean_measured(
    df: DataFrame, land: Callable[[DataFrame], DataFrame], steps: Sequence[Step] = STEPS, chunk_days: int = CHUNK_DAYS
) -> tuple[DataFrame, DataFrame]:
    """The cleaned rows, as `land` gives them back, and one row of metrics for each step that ran.

    `land` writes a frame and reads it again (such as `sources.shared.landed`). Steps of this
    package in a row run as one plan: each leaves on the rows how many nulls it left and what it
    changed, these columns are written with the rows and summed up from there, so nothing is
    cleaned twice, and a task that runs again does not count again. A caller's step may add or drop
    rows; what it gets and gives is written, and counted as written.

    Metrics: rows and nulls of the measures before and after; `changed` are night rows, outliers
    or, for any other step of this package, nulls resolved, and null for a caller's; the
    percentages are of rows, and for outliers of wind values.
    """
    names, spark = df.columns, df.sparkSession
    rows, told, k = df, [], 0
    while k < len(steps):
        own = getattr(steps[k], "keeps_keys", False)
        run = 1
        while own and k + run < len(steps) and getattr(steps[k + run], "keeps_keys", False):
            run += 1
        rows, metrics = (_measured_run if own else _measured_step)(rows, land, steps[k : k + run], chunk_days)
        told += [(k + i + 1, _name(step), *m) for i, (step, m) in enumerate(zip(steps[k : k + run], metrics))]
        k += run
    return (rows if steps else land(df)).select(*names), spark.createDataFrame(told, METRICS)


def _measured_run(rows: DataFrame, land, steps: Sequence[Step], chunk_days: int) -> tuple[DataFrame, list[tuple]]:
    names = rows.columns
    rows = rows.withColumn("_missing_0", _missing(rows))
    for i, step in enumerate(steps):
        before, hit = rows.columns, f"_hit_{i + 1}"
        telling = _TELLING.get(step)
        rows = _applied(rows, step, (lambda df: telling[0](df, hit)) if telling else step, chunk_days)
        _need_columns(step, rows.columns, [*before, hit] if telling else before)
        if i + 1 < len(steps):
            rows = rows.withColumn(f"_missing_{i + 1}", _missing(rows))
    rows = land(rows.drop(*KEYS))
    flags = [c for c in rows.columns if c not in names]
    # What the last step leaves is counted on the rows as written, so that its expressions stand in the plan once.
    rows = rows.withColumn(last := f"_missing_{len(steps)}", _missing(rows))
    flags.append(last)
    sums = rows.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in flags)).first()
    out = []
    for i, step in enumerate(steps):
        had, left = sums[f"_missing_{i}"], sums[f"_missing_{i + 1}"]
        changed, percent = had - left, None
        if telling := _TELLING.get(step):
            _, cells, decimals = telling
            changed = sums[f"_hit_{i + 1}"]
            percent = round(changed / max(1, sums.n * cells) * 100, decimals)
        out.append((sums.n, sums.n, had, left, changed, percent))
    return rows.select(*names), out


def _measured_step(rows: DataFrame, land, steps: Sequence[Step], chunk_days: int) -> tuple[DataFrame, list[tuple]]:
    (step,) = steps
    before = land(rows)
    after = _applied(before, step, step, chunk_days)
    _need_columns(step, after.columns, before.columns)
    after = land(after)
    counts = [x.agg(F.count("*"), F.coalesce(F.sum(_missing(x)), F.lit(0))).first() for x in (before, after)]
    (n, had), (m, left) = counts
    return after, [(n, m, had, left, None, None)]


def stage_metrics(df: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """What each step changed, from one pass over the cleaned rows.

    Counted on the rows, not with accumulators, so tasks that run twice do not
    count twice.
    """
    rows = cut(df, chunk_days).withColumn("_night", F.coalesce(is_night(F.col(TIME)), F.lit(False)))
    rows = hampel(zero_at_night(rows), flag_prefix="_outlier_")

    def nulls() -> Column:
        return sum((F.col(c).isNull().cast("int") for c in MEASURES[1:]), F.col(MEASURES[0]).isNull().cast("int"))

    outliers = sum((F.col(f"_outlier_{c}").cast("int") for c in WIND[1:]), F.col(f"_outlier_{WIND[0]}").cast("int"))
    rows = impute(rows.withColumns({"_outliers": outliers, "_nulls": nulls()}).drop(*(f"_outlier_{c}" for c in WIND)))
    n, cells = F.count("*"), F.greatest(F.count("*") * len(WIND), F.lit(1))
    night, replaced = F.count_if("_night"), F.coalesce(F.sum("_outliers"), F.lit(0))
    had, left = F.coalesce(F.sum("_nulls"), F.lit(0)), F.coalesce(F.sum(nulls()), F.lit(0))
    return rows.drop(*KEYS).agg(
        n.alias("n_rows"),
        night.alias("night_rows"),
        F.round(night / F.greatest(n, F.lit(1)) * 100, 1).alias("night_percent"),
        replaced.alias("outliers"),
        F.round(replaced / cells * 100, 3).alias("outlier_percent"),
        had.alias("nulls_before"),
        left.alias("nulls_after"),
        (had - left).alias("nulls_resolved"),
    )
