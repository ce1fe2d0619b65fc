"""Irradiance filled from what a clear sky would give.

Between two readings the sun moves, so a line between their values is wrong near dawn and noon. Here
the share of the clear sky's irradiance that was measured, the clear-sky index, is filled along the
rows of daylight, and the clear sky gives the value back.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunsieve.functions.solar import clear_sky
from sunsieve.operators.impute import impute
from sunsieve.operators.series import by_chunk
from sunsieve.schema import IRRADIANCE, LATITUDE, LEAST_CLEAR_SKY, SOLAR_CONSTANT, TIME


@by_chunk
def impute_irradiance(
    df: DataFrame, columns: Sequence[str] = IRRADIANCE, latitude: float = LATITUDE, least: float = LEAST_CLEAR_SKY
) -> DataFrame:
    """Fill nulls of irradiance; what was measured stays.

    Daylight is where the clear sky gives `least` W/m² or more. There the index is interpolated by
    position among the station's rows of daylight, then filled forward at the end and backward at
    the start, and the value is index times clear sky, the solar constant at most. Elsewhere nulls
    become 0.0. A station without any value in daylight keeps its nulls there, and rows without a
    time stay as they are. Columns not in the frame are passed over.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    sky = "_clear_sky"
    rows = df.withColumn(sky, clear_sky(F.col(TIME), latitude))
    # Rows at night take no part: they neither have an index nor count as positions.
    index = {f"_index_{c}": F.col(c) / F.col(sky) for c in columns}
    day = impute(rows.where(F.col(sky) >= least).withColumns(index), list(index))

    def value(c: str) -> Column:
        found = F.col(f"_index_{c}") * F.col(sky)  # null without an index, which `least` would pass over
        return F.coalesce(c, F.when(found > SOLAR_CONSTANT, F.lit(SOLAR_CONSTANT)).otherwise(found))

    given = {c: value(c) for c in columns}
    day = day.withColumns(given).select(df.columns)
    night = rows.where(F.coalesce(F.col(sky) < least, F.lit(True)))
    dark = {c: F.when(F.col(sky).isNotNull(), F.coalesce(c, F.lit(0.0))).otherwise(F.col(c)) for c in columns}
    return day.unionByName(night.withColumns(dark).select(df.columns))
