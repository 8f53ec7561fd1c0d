"""Intermediate tables that several registered queries start from, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.functions.risk import clamp01
from pluvia.operators.windows import latest_per
from pluvia.plans.tables import Tables
from pluvia.schemas import county_dim
from pluvia.streaming.windows import onset_72h

WEEK_HOURS = 168


def windows_72h(t: Tables) -> DataFrame:
    return onset_72h(t.readings())


WINDOWS_72H = """SELECT county, time_bucket(INTERVAL '72 hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '72 hours', event_time, TIMESTAMP '1970-01-01') + INTERVAL '72 hours' AS window_end,
  sum(precipitation) AS cum_72hr_mm, min(precipitation) AS min_precipitation, count(*) AS event_count,
  coalesce(sum(precipitation) >= 20 AND min(precipitation) > 0, false) AS onset_flag
FROM readings GROUP BY ALL"""


def live(t: Tables) -> DataFrame:
    """The newest alert-like row per county that has any onset window; others have none."""
    rows = windows_72h(t).filter("cum_72hr_mm > 5").withColumn("alert_timestamp", F.col("window_end"))
    newest = latest_per(rows, ["county"], ["alert_timestamp"])
    return newest.select("county", "alert_timestamp", "cum_72hr_mm", "onset_flag")


LIVE = """SELECT county, max(window_end) AS alert_timestamp, arg_max(cum_72hr_mm, window_end) AS cum_72hr_mm,
  arg_max(onset_flag, window_end) AS onset_flag
FROM windows_72h WHERE cum_72hr_mm > 5 GROUP BY county"""


def scores(t: Tables) -> DataFrame:
    """A model-like probability for some of the counties."""
    raw = (F.avg("precipitation") - 0.15) * 20
    return (
        t.readings()
        .groupBy("county")
        .agg(clamp01(raw).alias("ml_probability"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") % 3 != 0)
        .drop("n")
    )


SCORES = """SELECT county, greatest(0, least(1, (avg(precipitation) - CAST(0.15 AS DOUBLE)) * 20)) AS ml_probability
FROM readings GROUP BY county HAVING count(*) % 3 <> 0"""

SERVING = {"windows_72h": WINDOWS_72H, "live": LIVE, "scores": SCORES}


def pairs(t: Tables) -> DataFrame:
    """Hourly mean temperature (y) with the mean of its hour of day (yhat) per county."""
    actual = hourly(t).select("county", "hour", F.col("temperature").alias("y"))
    of_day = F.hour("hour").alias("hour_of_day")
    forecast = actual.groupBy("county", of_day).agg(F.avg("y").alias("yhat"))
    return actual.withColumn("hour_of_day", F.hour("hour")).join(forecast, ["county", "hour_of_day"])


HOURLY = """SELECT county, date_trunc('hour', event_time) AS hour, sum(precipitation) AS precipitation,
  avg(temperature) AS temperature, avg(soil_moisture) AS soil_moisture, avg(humidity) AS humidity, count(*) AS readings
FROM readings GROUP BY ALL"""
PAIRS = """SELECT county, hour, hour(hour) AS hour_of_day, temperature AS y,
  avg(temperature) OVER (PARTITION BY county, hour(hour)) AS yhat FROM hourly"""


def hourly(t: Tables) -> DataFrame:
    return t.readings().groupBy("county", F.date_trunc("hour", "event_time").alias("hour")).agg(
        F.sum("precipitation").alias("precipitation"),
        F.avg("temperature").alias("temperature"),
        F.avg("soil_moisture").alias("soil_moisture"),
        F.avg("humidity").alias("humidity"),
        F.count(F.lit(1)).alias("readings"),
    )


def week_payloads(t: Tables) -> DataFrame:
    """Forecast-like payloads per county and epoch week: at most 168 hours per array."""
    week = F.floor(F.unix_seconds("hour") / (WEEK_HOURS * 3600)).alias("payload_id")
    # Pressure is a stand-in that is zero every fifth hour of the day.
    pressure = F.when(F.hour("hour") % 5 == 0, 0.0).otherwise(1000.0 + F.hour("hour"))
    rows = hourly(t).withColumn("pressure", pressure)
    fields = ["hour", "precipitation", "temperature", "soil_moisture", "humidity", "pressure"]
    grouped = rows.groupBy("county", week).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("h")
    )

    def array(name: str, out: str):
        return F.transform("h", lambda x: x[name]).alias(out)

    times = F.transform("h", lambda x: F.date_format(x["hour"], "yyyy-MM-dd'T'HH:mm")).alias("time")
    return grouped.select(
        "county",
        "payload_id",
        F.struct(
            times,
            array("precipitation", "precipitation"),
            array("temperature", "temperature_2m"),
            array("soil_moisture", "soil_moisture_0_to_1cm"),
            array("humidity", "relative_humidity_2m"),
            array("pressure", "surface_pressure"),
        ).alias("hourly"),
    )


WEEK_ROWS = """SELECT *, CAST(floor(epoch(hour) / 604800) AS BIGINT) AS payload_id,
  CASE WHEN hour(hour) % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(1000 + hour(hour) AS DOUBLE) END AS pressure,
  row_number() OVER (PARTITION BY county, CAST(floor(epoch(hour) / 604800) AS BIGINT) ORDER BY hour) AS k,
  count(*) OVER (PARTITION BY county, CAST(floor(epoch(hour) / 604800) AS BIGINT)) AS n
FROM hourly"""


def daily_payloads(t: Tables) -> DataFrame:
    """Seven-day forecast-like payloads per county and epoch week."""
    days = t.readings().groupBy("county", F.to_date("event_time").alias("day")).agg(
        F.sum("precipitation").alias("rain"), F.max("temperature").alias("hi")
    )
    week = F.floor(F.unix_date("day") / 7).alias("payload_id")
    grouped = days.groupBy("county", week).agg(
        F.array_sort(F.collect_list(F.struct("day", "rain", "hi"))).alias("d")
    )
    # The third array is missing, as in payloads of an older source.
    return grouped.select(
        "county",
        "payload_id",
        F.struct(
            F.transform("d", lambda x: x["day"].cast("string")).alias("time"),
            F.transform("d", lambda x: x["rain"]).alias("precipitation_sum"),
            F.transform("d", lambda x: x["hi"]).alias("temperature_2m_max"),
        ).alias("daily"),
    )


DAILY = """SELECT county, CAST(event_time AS DATE) AS day, sum(precipitation) AS rain, max(temperature) AS hi
FROM readings GROUP BY ALL"""


def counties(t: Tables) -> DataFrame:
    return county_dim(t.spark).drop("pos")
