"""Times without a zone: parsing, flooring to a grid, differences.

`date_trunc` would turn a zone-less time into one in the session zone, and
`window` drops rows without a time, so both are avoided here.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunsieve.schema import GRID_MINUTES, TIME_FORMAT


def parse_time(text: Column, fmt: str = TIME_FORMAT) -> Column:
    """Zone-less time of a text; text that does not fit is an error."""
    return F.to_timestamp_ntz(text, F.lit(fmt))


def floor_to_grid(time: Column, minutes: int = GRID_MINUTES) -> Column:
    """Start of the grid cell, counted from midnight. A null time stays null."""
    if minutes < 1 or 1440 % minutes:
        raise ValueError(f"a day is no multiple of {minutes} minutes")
    past = (F.hour(time) * 60 + F.minute(time)) % minutes
    return time - F.make_dt_interval(F.lit(0), F.lit(0), past, F.extract(F.lit("SECOND"), time))


def off_grid(time: Column, minutes: int = GRID_MINUTES) -> Column:
    """True where the minute is not on the grid; a null time is no violation."""
    return (F.hour(time) * 60 + F.minute(time)) % minutes != 0


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, whatever the session zone."""
    return (end - start).cast("interval minute").cast("bigint")
