"""Small column expressions shared by the steps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunsieve.schema import NULL_TOKENS, SOLAR_CONSTANT, STATION_ID_MAX


def blank_tokens(text: Column) -> Column:
    """Null for the texts that stand for a missing value, compared untrimmed."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def to_station(value: Column) -> Column:
    """Station number as SMALLINT; outside 0..255 is an error."""
    number = value.cast("double").cast("smallint")
    return F.when(number.isNull() | number.between(0, STATION_ID_MAX), number).otherwise(
        F.raise_error(F.concat(F.lit("station_id out of 0..255: "), number.cast("string")))
    )


def out_of_bounds(value: Column, upper: float = SOLAR_CONSTANT) -> Column:
    """Not null and outside [0, upper]. NaN sorts above every number, so it counts."""
    return value.isNotNull() & ((value < 0) | (value > upper))


def middle(name: str) -> str:
    """SQL for the median of an array sorted ascending without nulls; null when it is empty."""
    n = f"size(`{name}`)"
    lower, upper = (f"get(`{name}`, CAST({at} AS INT))" for at in (f"({n} - 1) DIV 2", f"{n} DIV 2"))
    return f"CASE WHEN {n} > 0 THEN ({lower} + {upper}) / 2 END"
