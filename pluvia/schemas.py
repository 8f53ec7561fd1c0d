"""Record schemas, the county dimension and the domain constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# County names with their coordinates, in the order the data model lists them.
COUNTIES = [
    ("Nairobi", -1.2921, 36.8219),
    ("Kisumu", -0.0917, 34.7679),
    ("Nakuru", -0.3031, 36.0800),
    ("Meru", 0.0467, 37.6491),
    ("Kitui", -1.3667, 38.0167),
    ("Garissa", -0.4532, 39.6461),
    ("Machakos", -1.5177, 37.2634),
    ("Eldoret", 0.5143, 35.2698),
    ("Kakamega", 0.2827, 34.7519),
    ("Embu", -0.5300, 37.4500),
]
COUNTY_NAMES = [name for name, _, _ in COUNTIES]

# The onset rule.
ONSET_MM = 20.0
ONSET_HOURS = 72
DRY_LOOKAHEAD_HOURS = 48

# Score bands (strict), blend weights, neutral model inputs.
HIGH_ABOVE = 0.7
MODERATE_ABOVE = 0.4
NEUTRAL_PRESSURE_HPA = 1013.0
NEUTRAL_TEMP_K = 295.15
KELVIN_OFFSET = 273.15

# Life of a snapshot row, lag that counts as critical.
SNAPSHOT_TTL_DAYS = 7
LAG_CRITICAL = 1000

MESSAGE = T.StructType(
    [
        T.StructField("county", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("precipitation", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("soil_moisture", T.DoubleType()),
    ]
)

# The older producer's message; adapted to MESSAGE names after parsing.
MESSAGE_V0 = T.StructType(
    [
        T.StructField("county", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("rainfall_mm", T.DoubleType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
    ]
)

# Field names of the forecast payloads.
HOURLY_FIELDS = [
    "precipitation",
    "temperature_2m",
    "soil_moisture_0_to_1cm",
    "relative_humidity_2m",
    "wind_speed_10m",
    "surface_pressure",
]
HOURLY = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in HOURLY_FIELDS]
)
DAILY_FIELDS = ["precipitation_sum", "temperature_2m_max", "temperature_2m_min"]
DAILY = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in DAILY_FIELDS]
)

# Columns of the climate file.
CLIMATE_CSV = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("number", T.LongType()),
        T.StructField("time", T.StringType()),
        T.StructField("pressure_hpa", T.DoubleType()),
        T.StructField("valid_time", T.TimestampType()),
        T.StructField("temperature_k", T.DoubleType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("step_hours", T.LongType()),
    ]
)

# Fields of the snapshot.
SNAPSHOT = T.StructType(
    [
        T.StructField("county", T.StringType()),
        T.StructField("alert_timestamp", T.TimestampType()),
        T.StructField("cum_72hr_mm", T.DoubleType()),
        T.StructField("onset_flag", T.BooleanType()),
        T.StructField("expires_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# Columns of the feature table, in its order.
FEATURES = [
    "lat",
    "lon",
    "region_encoded",
    "year",
    "month",
    "season_MAM",
    "season_JJA",
    "season_OND",
    "season_DJF",
    "temp_12mo_rolling",
    "onset_month_lag",
    "temperature_c",
]


def county_dim(spark: SparkSession) -> DataFrame:
    """The county dimension: ten rows, so always safe to broadcast; ``pos`` is its order."""
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("county"), F.lit(a).alias("lat"), F.lit(o).alias("lon"), F.lit(p).alias("pos"))
            for p, (n, a, o) in enumerate(COUNTIES)
        ]
    )
    return spark.range(0, 1, 1, 1).select(F.inline(rows))
