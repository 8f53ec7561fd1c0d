"""Data-quality checks and service metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.operators.filters import union_all
from pluvia.operators.joins import join_checked


def row_counts(tables: Mapping[str, DataFrame], min_rows: Mapping[str, int]) -> DataFrame:
    """Rows per table against a minimum."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(min_rows.get(name, 1)).alias("min_rows")
        )
        for name, df in tables.items()
    ]
    status = F.when(F.col("rows") >= F.col("min_rows"), "PASS").otherwise("FAIL")
    return union_all(parts).withColumn("status", status)


def overall_status(counts: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAIL")
    return counts.agg(
        failed.alias("failed"), F.when(failed > 0, "FAIL").otherwise("PASS").alias("status")
    )


def time_gaps(df: DataFrame, key: str, time: str, hours: int) -> DataFrame:
    """Gaps longer than ``hours`` (at least one) between consecutive rows of a key.

    Rows of one hour cannot be that far apart, so only the first and last of each hour
    are compared: the window sees at most one row per key and hour.
    """
    if hours < 1:
        raise ValueError("hours must be at least 1")
    per_hour = df.groupBy(key, F.date_trunc("hour", time).alias("_hour")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last")
    )
    series = Window.partitionBy(key).orderBy("_hour")
    gaps = per_hour.withColumn("gap_start", F.lag("_last").over(series))
    micros = F.unix_micros("_first") - F.unix_micros("gap_start")
    return gaps.filter(micros > hours * 3_600_000_000).select(
        key, "gap_start", F.col("_first").alias("gap_end"), (micros / 3.6e9).alias("gap_hours")
    )


def heat_events(pairs: DataFrame, key: str, sigmas: float) -> DataFrame:
    """Rows whose residual y - yhat exceeds ``sigmas`` standard deviations of their key."""
    rows = pairs.withColumn("residual", F.col("y") - F.col("yhat"))
    spread = rows.groupBy(key).agg(F.stddev("residual").alias("sigma"))
    return join_checked(rows, spread, [key]).filter(F.col("residual") > sigmas * F.col("sigma"))


def latency_percentiles(
    samples: DataFrame, time: str, endpoint: str, value: str
) -> DataFrame:
    """p50, p95, p99 and event count per minute and endpoint.

    A minute of one endpoint is a small group, so the exact built-in does it in one shuffle,
    with values counted map-side. For groups without such a bound there is ``quantiles``.
    """
    minute = samples.filter(F.col(value).isNotNull()).groupBy(
        F.window(time, "1 minute").start.alias("minute"), F.col(endpoint).alias("endpoint")
    )
    exact = minute.agg(
        F.percentile(value, [0.5, 0.95, 0.99]).alias("_p"), F.count(value).alias("events")
    )
    ranks = [F.col("_p")[k].alias(name) for k, name in enumerate(("p50", "p95", "p99"))]
    return exact.select("minute", "endpoint", *ranks, "events", (F.col("events") / 60.0).alias("events_per_second"))


def latency_sketches(samples: DataFrame, time: str, endpoint: str, value: str, k: int = 200) -> DataFrame:
    """(minute, endpoint, sketch): a mergeable quantile sketch a minute, to be stored.

    A sketch holds a few hundred values however many it has seen; up to ``k`` values it is exact, beyond that
    a rank is off by some 1.65 % of the values with k = 200 (99 % of the time), less with a larger one.
    """
    rows = samples.where(F.col(value).isNotNull())
    return rows.groupBy(F.window(time, "1 minute").start.alias("minute"), F.col(endpoint).alias("endpoint")).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    )


def merged_latency(sketches: DataFrame, length: str = "1 hour") -> DataFrame:
    """(start, endpoint, p50, p95, p99, events) of longer intervals, from the sketches of their minutes alone."""
    merged = sketches.groupBy(F.window("minute", length).start.alias("start"), "endpoint").agg(
        F.kll_merge_agg_double("sketch").alias("sketch")
    )
    ranks = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in ranks.items()]
    return merged.select("start", "endpoint", *found, F.kll_sketch_get_n_double("sketch").alias("events"))


def sustained_breaches(
    percentiles: DataFrame, keys: Sequence[str], threshold: float, steps: int, step_seconds: int = 60
) -> DataFrame:
    """Runs of at least ``steps`` consecutive intervals whose p95 is over the threshold.

    Gaps and islands over one row per interval and key.
    """
    over = percentiles.filter(F.col("p95") > threshold)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("minute"))
    island = (F.unix_seconds(F.col("minute").cast("timestamp")) / step_seconds).cast("bigint") - rank
    return (
        over.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(
            F.min("minute").alias("breach_start"),
            F.max("minute").alias("breach_end"),
            F.count(F.lit(1)).alias("intervals"),
            F.max("p95").alias("worst_p95"),
        )
        .filter(F.col("intervals") >= steps)
        .drop("_island")
    )


def job_outcomes(jobs: DataFrame, time: str, result: str) -> DataFrame:
    return jobs.groupBy(F.window(time, "1 hour").start.alias("hour"), F.col(result).alias("result")).agg(
        F.count(F.lit(1)).alias("jobs")
    )
