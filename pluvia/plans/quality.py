"""Data-quality checks and service metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.operators import quality as q
from pluvia.operators.ordered import quantiles
from pluvia.plans import common
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.tables import sql
from pluvia.session import new_folder
from pluvia.streaming.jobs import lag_report

MIN_ROWS = {"events": 1000, "orders": 10_000, "lineitem": 1_000_000}


@query(
    "dq_row_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {i('count(*)', 'rows')}, {i(str(m), 'min_rows')}, "
        f"CASE WHEN count(*) >= {m} THEN 'PASS' ELSE 'FAIL' END AS status FROM {n}"
        for n, m in MIN_ROWS.items()
    ),
)
def row_counts(t):
    return q.row_counts({n: t.raw(n) for n in MIN_ROWS}, MIN_ROWS)


@query(
    "dq_overall_status",
    f"""SELECT {i("sum(f)", "failed")}, CASE WHEN sum(f) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ("""
    + " UNION ALL ".join(f"SELECT CASE WHEN count(*) < {m} THEN 1 ELSE 0 END AS f FROM {n}" for n, m in MIN_ROWS.items())
    + ")",
)
def overall(t):
    return q.overall_status(row_counts(t))


@query(
    "dq_time_gaps",
    sql(
        f"""SELECT county, {ts("p", "gap_start")}, {ts("ds", "gap_end")}, {d("(epoch_us(ds) - epoch_us(p)) / CAST(3.6e9 AS DOUBLE)", "gap_hours")}
        FROM (SELECT county, ds, lag(ds) OVER (PARTITION BY county ORDER BY ds, reading_id) AS p FROM enriched)
        WHERE ds - p > INTERVAL 3 HOUR""",
        "enriched",
    ),
)
def time_gaps(t):
    return q.time_gaps(t.enriched(), "county", "ds", 3)


@query(
    "ml_heat_event",
    sql(
        f"""SELECT county, {ts("hour", "hour")}, {d("y - yhat", "residual")}, {d("s", "sigma")}
        FROM (SELECT *, stddev_samp(y - yhat) OVER (PARTITION BY county) AS s FROM pairs) WHERE y - yhat > 1.5 * s""",
        "readings",
        hourly=common.HOURLY,
        pairs=common.PAIRS,
    ),
)
def heat_event(t):
    return q.heat_events(common.pairs(t), "county", 1.5).select("county", "hour", "residual", "sigma")


PERCENTILES = """SELECT date_trunc('minute', ts) AS minute, event_type AS endpoint, quantile_cont(value, 0.5) AS p50,
  quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99, count(*) AS events FROM events GROUP BY ALL"""


@query(
    "metric_latency_percentiles",
    sql(
        f"""SELECT {ts("minute", "minute")}, endpoint, {d("p50", "p50")}, {d("p95", "p95")}, {d("p99", "p99")}, {i("events", "events")},
        {d("events / 60", "events_per_second")} FROM percentiles""",
        percentiles=PERCENTILES,
    ),
)
def latency_percentiles(t):
    return q.latency_percentiles(t.raw("events"), "ts", "event_type", "value")


@query(
    "metric_latency_sketch",
    f"""SELECT {ts("date_trunc('hour', ts)", "start")}, event_type AS endpoint, {d("quantile_disc(value, 0.5)", "p50")}, {d("quantile_disc(value, 0.95)", "p95")},
    {d("quantile_disc(value, 0.99)", "p99")}, {i("count(*)", "events")} FROM events GROUP BY date_trunc('hour', ts), event_type""",
)
def latency_sketch(t):
    """Hours from the stored sketches of their minutes; with few events in an hour they are exact."""
    path = new_folder(t.spark, "sketches")
    q.latency_sketches(t.raw("events"), "ts", "event_type", "value").write.parquet(path)
    return q.merged_latency(t.spark.read.parquet(path))


@query(
    "metric_sustained_breach",
    sql(
        f"""SELECT endpoint, {ts("min(bucket)", "breach_start")}, {ts("max(bucket)", "breach_end")}, {i("count(*)", "intervals")}, {d("max(p95)", "worst_p95")}
        FROM (SELECT *, CAST(epoch(bucket) / 21600 AS BIGINT) - row_number() OVER (PARTITION BY endpoint ORDER BY bucket) AS island
              FROM (SELECT event_type AS endpoint, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS bucket,
                      quantile_cont(value, 0.95) AS p95 FROM events GROUP BY ALL) WHERE p95 > 120)
        GROUP BY endpoint, island HAVING count(*) >= 3"""
    ),
)
def sustained_breach(t):
    """Six-hour intervals stand in for minutes: the given events are sparse."""
    buckets = t.raw("events").select(
        F.window("ts", "6 hours").start.alias("minute"), F.col("event_type").alias("endpoint"), "value"
    )
    p95 = quantiles(buckets, ["minute", "endpoint"], "value", {"p95": 0.95})
    return q.sustained_breaches(p95, ["endpoint"], 120.0, 3, step_seconds=21_600)


@query(
    "metric_job_outcomes",
    f"""SELECT {ts("date_trunc('hour', ts)", "hour")}, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS result,
    {i("count(*)", "jobs")} FROM events GROUP BY date_trunc('hour', ts), event_type = 'error'""",
)
def job_outcomes(t):
    result = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    return q.job_outcomes(t.raw("events").withColumn("result", result), "ts", "result")


@query(
    "stream_lag_report",
    f"""SELECT topic, {i("sum(e - coalesce(c, 0))", "lag")}, CASE WHEN sum(e - coalesce(c, 0)) > 1000 THEN 'CRITICAL' ELSE 'HEALTHY' END AS status
    FROM (SELECT event_type AS topic, user_id, max(event_id) AS e, max(event_id) FILTER (value > 100) AS c FROM events GROUP BY ALL) GROUP BY topic""",
)
def lag(t):
    """Users stand in for partitions: newest event against the newest one over a value."""
    offsets = t.raw("events").groupBy(F.col("event_type").alias("topic"), F.col("user_id").alias("partition")).agg(
        F.max("event_id").alias("end_offset"),
        F.max(F.when(F.col("value") > 100, F.col("event_id"))).alias("committed_offset"),
    )
    return lag_report(offsets)
