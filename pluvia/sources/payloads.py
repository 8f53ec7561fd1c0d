"""Forecast payloads: structs of parallel arrays, and gridded cubes as nested arrays.

One payload holds one location's forecast (at most a few hundred hours), so its
arrays are small; the work is spread over payloads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.functions.risk import round_mm
from pluvia.schemas import DAILY, HOURLY, NEUTRAL_PRESSURE_HPA, ONSET_HOURS, ONSET_MM

# Reading name of each hourly and daily field.
READING_NAMES = {
    "precipitation": "precipitation",
    "temperature_2m": "temperature",
    "soil_moisture_0_to_1cm": "soil_moisture",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
}
DAILY_NAMES = {
    "precipitation_sum": "precipitation_mm",
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
}
FORECAST_HOURS = 168


def parse_payload(text: DataFrame, column: str, part: str) -> DataFrame:
    """Replace a JSON text column by its ``hourly`` or ``daily`` struct."""
    schema = T.StructType([T.StructField(part, HOURLY if part == "hourly" else DAILY)])
    return text.withColumn(part, F.from_json(column, schema)[part]).drop(column)


def _field(payloads: DataFrame, struct: str, name: str) -> Column:
    """An array of the struct; null where this source does not have it."""
    known = payloads.schema[struct].dataType.fieldNames()
    return F.col(f"{struct}.{name}") if name in known else F.lit(None).cast("array<double>")


def _rows(payloads: DataFrame, struct: str, names: dict[str, str], time: str) -> DataFrame:
    """Zip the parallel arrays; a missing or absent array gives nulls."""
    arrays = F.arrays_zip(
        F.col(f"{struct}.time").alias("time"),
        *[
            F.coalesce(_field(payloads, struct, c), F.array().cast("array<double>")).alias(c)
            for c in names
        ],
    )
    keep = [c for c in payloads.columns if c != struct]
    return (
        payloads.select(*keep, F.explode(arrays).alias("h"))
        .filter(F.col("h.time").isNotNull())
        .select(*keep, F.col("h.time").alias(time), *[F.col(f"h.{c}").alias(n) for c, n in names.items()])
    )


def hourly_rows(payloads: DataFrame) -> DataFrame:
    """One row per hour of every payload."""
    return _rows(payloads, "hourly", READING_NAMES, "time")


def daily_rows(payloads: DataFrame) -> DataFrame:
    """One row per forecast day of every payload."""
    return _rows(payloads, "daily", DAILY_NAMES, "date")


def latest_reading(payloads: DataFrame) -> DataFrame:
    """The last hour of each payload; rain defaults to zero, other measures stay null."""
    keep = [c for c in payloads.columns if c != "hourly"]
    size = F.size("hourly.time")

    def last(c: str) -> Column:
        return F.round(F.try_element_at(_field(payloads, "hourly", c), size), 4)

    fields = {n: last(c) for c, n in READING_NAMES.items()}
    fields["precipitation"] = F.coalesce(fields["precipitation"], F.lit(0.0))
    return payloads.filter(size > 0).select(
        *keep,
        F.try_element_at(F.col("hourly.time"), size).alias("timestamp"),
        *[c.alias(n) for n, c in fields.items()],
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def trailing_snapshot(payloads: DataFrame) -> DataFrame:
    """The last 72 hours' rain and the temperatures now, 6 and 24 positions back."""
    keep = [c for c in payloads.columns if c != "hourly"]
    rain, temps, pressure = (
        F.col("hourly.precipitation"),
        F.col("hourly.temperature_2m"),
        _field(payloads, "hourly", "surface_pressure"),
    )
    last72 = F.slice(rain, F.greatest(F.size(rain) - (ONSET_HOURS - 1), F.lit(1)), ONSET_HOURS)
    latest_pressure = F.try_element_at(pressure, F.lit(-1))

    def back(n: int) -> Column:
        return F.try_element_at(temps, F.lit(-1 - n))

    return payloads.select(
        *keep,
        F.coalesce(_total(last72), F.lit(0.0)).alias("cum_72hr_mm"),
        back(0).alias("temp_c"),
        back(6).alias("temp_lag_6h_c"),
        back(24).alias("temp_lag_24h_c"),
        F.when(latest_pressure != 0, latest_pressure)
        .otherwise(NEUTRAL_PRESSURE_HPA)
        .alias("pressure_hpa"),
    )


def forecast_onset(payloads: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Onset signal of a forecast: the first 72 hours, then any dry hour up to hour 168.

    Shorter forecasts get ``insufficient_data`` and null signals. Null rain is not counted.
    """
    keep = [c for c in payloads.columns if keep_payload or c != "hourly"]
    rain, times = F.col("hourly.precipitation"), F.col("hourly.time")
    enough = F.size(rain) >= ONSET_HOURS
    total = _total(F.slice(rain, 1, ONSET_HOURS))
    ahead = F.slice(rain, ONSET_HOURS + 1, FORECAST_HOURS - ONSET_HOURS)
    dry = F.exists(F.filter(ahead, lambda x: x.isNotNull()), lambda x: x == 0)
    return payloads.select(
        *keep,
        F.when(enough, "ok").otherwise("insufficient_data").alias("onset_signal"),
        F.when(enough, round_mm(total)).alias("cum_precipitation_72hr_mm"),
        F.when(enough, dry).alias("dry_spell_detected"),
        F.when(enough, (total >= ONSET_MM) & ~dry).alias("onset_flag"),
        F.when(enough, F.try_element_at(times, F.lit(1))).alias("onset_window_start"),
        F.when(enough, F.try_element_at(times, F.lit(ONSET_HOURS))).alias("onset_window_end"),
    )


def flatten_grid(
    cubes: DataFrame,
    field: str,
    name: str,
    lat: str = "latitude",
    lon: str = "longitude",
    keep: Sequence[str] = (),
) -> DataFrame:
    """A lat x lon field (array of arrays) to rows; coordinate arrays match by position."""
    rows = cubes.select(*keep, lat, lon, F.posexplode(field).alias("_i", "_row"))
    cells = rows.select(*keep, lat, lon, "_i", F.posexplode("_row").alias("_j", name))
    return cells.select(
        *keep,
        F.try_element_at(F.col(lat), F.col("_i") + 1).alias("lat"),
        F.try_element_at(F.col(lon), F.col("_j") + 1).alias("lon"),
        name,
    ).filter(F.col(name).isNotNull())
