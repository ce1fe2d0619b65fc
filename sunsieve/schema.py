"""Column groups, fixed values and table types."""

from pyspark.sql import types as T

TIME = "date_time"
STATION = "station_id"
TARGET = "power"
DAY = "day"

# Column names and groups of the data set.
NWP = (
    "nwp_globalirrad",
    "nwp_directirrad",
    "nwp_temperature",
    "nwp_humidity",
    "nwp_windspeed",
    "nwp_winddirection",
    "nwp_pressure",
)
LMD = (
    "lmd_totalirrad",
    "lmd_diffuseirrad",
    "lmd_temperature",
    "lmd_pressure",
    "lmd_winddirection",
    "lmd_windspeed",
)
MEASURES = (*NWP, *LMD, TARGET)
DELTAS = {
    "delta_globalirrad": ("nwp_globalirrad", "lmd_totalirrad"),
    "delta_temperature": ("nwp_temperature", "lmd_temperature"),
    "delta_pressure": ("nwp_pressure", "lmd_pressure"),
    "delta_windspeed": ("nwp_windspeed", "lmd_windspeed"),
}
IRRADIANCE = ("nwp_globalirrad", "nwp_directirrad", "lmd_totalirrad", "lmd_diffuseirrad")
NIGHT_ZERO = (*IRRADIANCE, TARGET)
WIND = ("nwp_windspeed", "lmd_windspeed")

# Physical and filter constants, formats, contract sizes.
SOLAR_CONSTANT = 1361.0
GRID_MINUTES = 15
STATIONS = 10
EXPECTED_ROWS = 271_968
HAMPEL_WINDOW = 5
HAMPEL_THRESHOLD = 3.0
HAMPEL_FACTOR = 1.4826
MAD_FLOOR = 1e-10
LATITUDE = 38.0
DECLINATION = 23.45
# Haurwitz's clear sky, and the irradiance from which it is taken for daylight.
CLEAR_SKY, CLEAR_SKY_LOSS = 1098.0, 0.059
LEAST_CLEAR_SKY = 1.0
NULL_TOKENS = ("", "NA", "null", "NaN")
STATION_ID_MAX = 255
COMPRESSION = "zstd"
GOLD_PREFIX = "gold/pvod_"
LOAD_PREFIX = "pvod_load_"
MAX_SCAN_BYTES = 104_857_600

# One or two digits per part, as the usual "%Y-%m-%d %H:%M" accepts; seconds where there are some.
TIME_FORMAT = "yyyy-M-d H:m[:s][.SSSSSS]"
WRITTEN_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

READING_TYPES = {TIME: T.TimestampNTZType(), STATION: T.ShortType(), **{c: T.DoubleType() for c in MEASURES}}
FINAL_TYPES = {**READING_TYPES, **{c: T.DoubleType() for c in DELTAS}}
FINAL_SCHEMA = T.StructType([T.StructField(c, t) for c, t in FINAL_TYPES.items()])
