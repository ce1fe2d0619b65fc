"""Solar elevation from local clock time at one latitude."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunsieve.schema import CLEAR_SKY, CLEAR_SKY_LOSS, DECLINATION, LATITUDE


def solar_elevation(time: Column, latitude: float = LATITUDE) -> Column:
    """Elevation in radians, the clock taken as solar time."""
    hours = F.hour(time) + F.minute(time) / F.lit(60.0)
    declination = F.lit(math.radians(DECLINATION)) * F.sin(
        F.lit(2.0 * math.pi / 365.0) * (F.lit(284.0) + F.dayofyear(time))
    )
    hour_angle = F.lit(math.radians(15.0)) * (hours - F.lit(12.0))
    at = math.radians(latitude)
    return F.asin(
        F.lit(math.sin(at)) * F.sin(declination)
        + F.lit(math.cos(at)) * F.cos(declination) * F.cos(hour_angle)
    )


def is_night(time: Column, latitude: float = LATITUDE) -> Column:
    """True at or below the horizon, null where the time is null."""
    return solar_elevation(time, latitude) <= 0.0


def clear_sky(time: Column, latitude: float = LATITUDE) -> Column:
    """Irradiance of a clear sky in W/m² after Haurwitz: 0 at or below the horizon, null where the time is null."""
    height = F.sin(solar_elevation(time, latitude))
    return F.when(height > 0, F.lit(CLEAR_SKY) * height * F.exp(-F.lit(CLEAR_SKY_LOSS) / height)).when(height <= 0, F.lit(0.0))
