"""Enrichment, serving and layer-merging joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_checked(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach a dimension without a hint, and without a job of its own.

    AQE knows the bytes of the dimension once its stage has run: it broadcasts below
    ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions above.
    """
    return fact.join(dim, list(on), how)


def enrich_with_county(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Readings with the county of their coordinate; unmapped coordinates drop out."""
    return join_checked(readings, mapping, ["lat", "lon"])


def risk_map_rows(counties: DataFrame, live: DataFrame) -> DataFrame:
    """Every county with its live alert; a county without one has zero rain."""
    return counties.join(live, "county", "left").withColumn(
        "cum_72hr_mm", F.coalesce("cum_72hr_mm", F.lit(0.0))
    )


def with_model_probability(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach scores; an absent or invalid score stays null."""
    return rows.join(scores.select("county", "ml_probability"), "county", "left")


def actual_vs_forecast(actual: DataFrame, forecast: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with both values and their difference y - yhat."""
    return (
        actual.join(forecast, list(on))
        .dropna(subset=["y", "yhat"])
        .withColumn("residual", F.col("y") - F.col("yhat"))
    )


def merge_batch_and_speed(
    batch: DataFrame, speed: DataFrame, keys: Sequence[str] = ("county", "window_start")
) -> DataFrame:
    """Union of both layers, one row per key; the batch row wins where both exist."""
    rows = batch.withColumns({"_rank": F.lit(0), "layer": F.lit("batch")}).unionByName(
        speed.withColumns({"_rank": F.lit(1), "layer": F.lit("speed")})
    )
    values = [c for c in rows.columns if c not in (*keys, "_rank")]
    best = F.min_by(F.struct(*values), F.col("_rank")).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*")


def live_vs_baseline(live: DataFrame, history: DataFrame) -> DataFrame:
    """Live totals against the mean total of the same county and calendar month."""
    baseline = history.groupBy("county", F.month("observation_date").alias("month")).agg(
        F.avg("cum_72hr_mm").alias("expected_mm")
    )
    rows = live.withColumn("month", F.month("window_start"))
    joined = join_checked(rows, baseline, ["county", "month"], "left")
    return joined.withColumns(
        {
            "difference_mm": F.col("cum_72hr_mm") - F.col("expected_mm"),
            "ratio": F.try_divide("cum_72hr_mm", "expected_mm"),
        }
    )
