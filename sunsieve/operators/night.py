"""Zero what the sun cannot cause."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.functions.solar import is_night
from sunsieve.schema import LATITUDE, NIGHT_ZERO, TIME


def zero_at_night(
    df: DataFrame, columns: Sequence[str] = NIGHT_ZERO, latitude: float = LATITUDE
) -> DataFrame:
    """0.0 at night, nulls included; a row without a time stays as it is."""
    night = "_is_night"  # once, not once per column
    rows = df.withColumn(night, is_night(F.col(TIME), latitude))
    return rows.withColumns({c: F.when(F.col(night), F.lit(0.0)).otherwise(F.col(c)) for c in columns}).drop(night)


zero_at_night.keeps_keys = True
