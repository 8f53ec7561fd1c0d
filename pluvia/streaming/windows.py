"""Event-time windows. Each function takes a batch or a streaming DataFrame unchanged.

Windows align to 1970-01-01 UTC. In append mode a window is emitted once the watermark
passes its end. Overlapping windows expand rows, so they first reduce readings to one
row per county and hour and expand those: 24 rows per hour, not 24 per reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.functions.risk import onset_flag
from pluvia.schemas import DRY_LOOKAHEAD_HOURS, ONSET_HOURS, ONSET_MM

# How late a reading may be, per window family.
LATE_3H = "30 minutes"
LATE_24H = "2 hours"
LATE_72H = "2 hours"
LATE_72H_SLIDING = "12 hours"
HOUR = "1 hour"


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop(
        "window"
    )


def tumbling_3h(events: DataFrame, late: str = LATE_3H) -> DataFrame:
    """Rain, mean temperature, mean soil moisture and count per county and 3 hours."""
    return _flat(
        events.withWatermark("event_time", late)
        .groupBy(F.window("event_time", "3 hours"), "county")
        .agg(
            F.sum("precipitation").alias("cum_precipitation_mm"),
            F.avg("temperature").alias("avg_temperature_c"),
            F.avg("soil_moisture").alias("avg_soil_moisture"),
            F.count(F.lit(1)).alias("event_count"),
        )
    )


def hourly_partials(events: DataFrame, late: str) -> DataFrame:
    """Sums and counts per county and hour, from which any longer window follows."""
    return (
        events.withWatermark("event_time", late)
        .groupBy(F.window("event_time", HOUR).alias("hour"), "county")
        .agg(
            F.sum("precipitation").alias("rain"),
            F.count_if(F.col("precipitation") == 0).alias("dry"),
            F.sum("temperature").alias("temperature_sum"),
            F.count("temperature").alias("temperature_count"),
            F.count(F.lit(1)).alias("event_count"),
        )
    )


def _sliding(events: DataFrame, length: str, slide: str, late: str):
    hours = hourly_partials(events, late)
    return hours.groupBy(F.window(F.window_time("hour"), length, slide), "county")


def _mean_temperature() -> Column:
    return F.try_divide(F.sum("temperature_sum"), F.sum("temperature_count"))


def sliding_24h(events: DataFrame, late: str = LATE_24H) -> DataFrame:
    """24 hours every hour: rain, mean temperature, count."""
    return _flat(
        _sliding(events, "24 hours", HOUR, late).agg(
            F.sum("rain").alias("cum_precipitation_mm"),
            _mean_temperature().alias("avg_temperature_c"),
            F.sum("event_count").alias("event_count"),
        )
    )


def sliding_72h(events: DataFrame, late: str = LATE_72H_SLIDING) -> DataFrame:
    """72 hours every 6 hours with a risk label; no dry test."""
    rows = _flat(
        _sliding(events, "72 hours", "6 hours", late).agg(
            F.sum("rain").alias("total_rainfall_72h"), _mean_temperature().alias("avg_temp_72h")
        )
    )
    risky = F.col("total_rainfall_72h") >= ONSET_MM
    return rows.withColumn("onset_alert", F.when(risky, "HIGH RISK").otherwise("LOW RISK"))


def totals_72h(events: DataFrame, late: str = LATE_72H) -> DataFrame:
    """Rain, lowest reading and count per county and 72 hours."""
    return _flat(
        events.withWatermark("event_time", late)
        .groupBy(F.window("event_time", "72 hours"), "county")
        .agg(*_totals())
    )


def _totals() -> list[Column]:
    return [
        F.sum("precipitation").alias("cum_72hr_mm"),
        F.min("precipitation").alias("min_precipitation"),
        F.count(F.lit(1)).alias("event_count"),
    ]


def flag_onsets(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "onset_flag", onset_flag(F.col("cum_72hr_mm"), F.col("min_precipitation"))
    )


def onset_72h(events: DataFrame, late: str = LATE_72H) -> DataFrame:
    """The stream rule: 72 hours with enough rain and no dry reading among them."""
    return flag_onsets(totals_72h(events, late))


def onset_exact(events: DataFrame, slide: str = "24 hours", late: str = LATE_72H) -> DataFrame:
    """The look-ahead rule: enough rain in 72 hours and no dry reading in the 48 after.

    A window spans all 120 hours, so a stream emits it 48 hours after the rain window.
    """
    ahead = ONSET_HOURS + DRY_LOOKAHEAD_HOURS
    wet_end = F.col("window.start") + F.make_dt_interval(hours=F.lit(ONSET_HOURS))
    in_wet = F.col("hour.start") < wet_end
    # The hour's place relative to its window is only known after expansion.
    hours = hourly_partials(events, late)
    expanded = hours.select(
        F.window(F.window_time("hour"), f"{ahead} hours", slide).alias("window"),
        "hour",
        "county",
        "rain",
        "dry",
        "event_count",
    )
    totals = expanded.groupBy("window", "county").agg(
        F.sum(F.when(in_wet, F.col("rain"))).alias("cum_72hr_mm"),
        F.coalesce(F.sum(F.when(~in_wet, F.col("dry"))), F.lit(0)).alias("dry_after"),
        F.sum(F.when(in_wet, F.col("event_count"))).alias("event_count"),
    )
    flagged = totals.withColumn(
        "onset_flag",
        F.coalesce((F.col("cum_72hr_mm") >= ONSET_MM) & (F.col("dry_after") == 0), F.lit(False)),
    )
    start = F.col("window.start")
    return flagged.withColumns(
        {"window_start": start, "window_end": start + F.make_dt_interval(hours=F.lit(ONSET_HOURS))}
    ).drop("window")


def dedup_hourly(events: DataFrame, late: str = LATE_72H) -> DataFrame:
    """One reading per county and hour: a poller repeats the hour's value every minute.

    A stream keeps the first to arrive, a batch the earliest; equal where repeats are equal.
    """
    timed = events.withWatermark("event_time", late)
    hour = F.date_trunc("hour", "event_time")
    if events.isStreaming:
        return timed.withColumn("hour", hour).dropDuplicatesWithinWatermark(["county", "hour"])
    values = [c for c in events.columns if c != "county"]
    order = F.struct(*[c for c in ("event_time", "reading_id") if c in events.columns])
    return (
        timed.groupBy("county", hour.alias("hour"))
        .agg(F.min_by(F.struct(*values), order).alias("_row"))
        .select("county", "_row.*", "hour")
    )


def onset_72h_of_hours(events: DataFrame, late: str = LATE_72H) -> DataFrame:
    """The stream rule over one reading per county and hour, whatever a poller repeats.

    Windows begin at full hours, so all repeats of an hour fall into the same one. On a stream
    the watermark of the first step goes on to the second.
    """
    hours = dedup_hourly(events, late)
    if not events.isStreaming:
        return onset_72h(hours, late)
    return flag_onsets(_flat(hours.groupBy(F.window("event_time", "72 hours"), "county").agg(*_totals())))
