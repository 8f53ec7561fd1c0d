"""Batch onset rules. The window rules shared with streams are in ``pluvia.streaming.windows``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.functions.risk import round_mm
from pluvia.operators.ordered import ROWS_PER_TASK, over_rows
from pluvia.schemas import DRY_LOOKAHEAD_HOURS, ONSET_HOURS, ONSET_MM

NANOMETRES = 1_000_000  # per mm


def onset_by_rows(
    readings: DataFrame,
    threshold: float = ONSET_MM,
    rows: int = ONSET_HOURS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every run of 72 consecutive readings with enough rain and no dry reading.

    Null rain counts as zero, hence as dry. Indexes are 0-based within the county.
    Rain is added as whole nanometres: the sum, and so the comparison with the
    threshold, does not depend on the order of addition.
    """
    rain = F.coalesce("precipitation", F.lit(0.0))
    exact = F.round(rain * NANOMETRES).cast("bigint")

    def columns(w: Window) -> list[dict]:
        # Running sums and their difference over the run: two steps per row, not 72.
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        dry = F.when(rain == 0, 1).otherwise(0)
        sums = {"_rain": F.sum(exact).over(so_far), "_dry": F.sum(dry).over(so_far)}
        return [
            sums,
            {c: F.col(c) - F.coalesce(F.lag(c, rows).over(w), F.lit(0)) for c in sums},
        ]

    runs = over_rows(
        readings.select("county", "event_time", "reading_id", "precipitation"),
        ["county"],
        ["event_time", "reading_id"],
        rows,
        columns,
        position="window_end",
        rows_per_task=rows_per_task,
    )
    hit = (F.col("_rain") >= round(threshold * NANOMETRES)) & (F.col("_dry") == 0)
    return runs.filter((F.col("window_end") >= rows - 1) & hit).select(
        "county",
        round_mm(F.col("_rain") / NANOMETRES).alias("cum_72hr_mm"),
        F.lit(True).alias("onset_flag"),
        (F.col("window_end") - (rows - 1)).alias("window_start"),
        "window_end",
    )


def hourly_rain(readings: DataFrame) -> DataFrame:
    """Rain per county and hour: the small table that time-frame rules run on."""
    return readings.groupBy("county", F.date_trunc("hour", "event_time").alias("hour")).agg(
        F.sum("precipitation").alias("rain"), F.count(F.lit(1)).alias("readings")
    )


def onset_trailing(
    readings: DataFrame,
    threshold: float = ONSET_MM,
    hours: int = ONSET_HOURS,
    dry_hours: int = DRY_LOOKAHEAD_HOURS,
) -> DataFrame:
    """At each hour: rain of the trailing 72 h and zero-rain hours of the trailing 48 h.

    The window runs over hours, not readings: at most one row per county and hour, so a
    decade of one county is under 90,000 rows and a frame at most 72.
    """
    second = F.unix_seconds("hour")
    series = Window.partitionBy("county").orderBy("_s")
    wet = series.rangeBetween(-(hours - 1) * 3600, 0)
    recent = series.rangeBetween(-(dry_hours - 1) * 3600, 0)
    zero = F.when(F.col("rain") == 0, 1).otherwise(0)
    return (
        hourly_rain(readings)
        .withColumn("_s", second)
        .withColumns(
            {"cum_72hr_mm": F.sum("rain").over(wet), "zero_hours_48": F.sum(zero).over(recent)}
        )
        .withColumn(
            "onset_flag",
            F.coalesce((F.col("cum_72hr_mm") >= threshold) & (F.col("zero_hours_48") == 0), F.lit(False)),
        )
        .drop("_s")
    )
