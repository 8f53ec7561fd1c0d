"""Sinks, checked by reading back what they wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pluvia.functions.weather import county_from_coord
from pluvia.operators.aggregates import latency_summary
from pluvia.operators.joins import enrich_with_county
from pluvia.operators.sketch import heavy_keys
from pluvia.operators.windows import climate_features
from pluvia.plans import common
from pluvia.plans.aggregates import DEFAULT, LATENCY_SQL, _cells_sql, _sketch_ctes
from pluvia.plans.projections import COUNTY_SQL, FEATURES_SQL
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.tables import sql
from pluvia.schemas import SNAPSHOT
from pluvia.session import new_folder
from pluvia.sinks import writers
from pluvia.streaming import windows
from pluvia.streaming.jobs import BaselineSink, OnsetSink, run_together, to_baseline_sink, to_files, to_onset_sink

NOW = "2024-02-01 00:00:00"


def closed(late: str) -> str:
    """Windows a drained stream has emitted: the final watermark has passed their end."""
    return f"window_end <= (SELECT max(event_time) FROM readings) - INTERVAL '{late}'"


TUMBLING_3H = """SELECT county, time_bucket(INTERVAL '3 hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '3 hours', event_time, TIMESTAMP '1970-01-01') + INTERVAL '3 hours' AS window_end,
  sum(precipitation) AS rain, avg(temperature) AS temperature, avg(soil_moisture) AS soil, count(*) AS n FROM readings GROUP BY ALL"""
TUMBLING_COLUMNS = (
    f"county, {ts('window_start', 'window_start')}, {ts('window_end', 'window_end')}, {d('rain', 'cum_precipitation_mm')}, "
    f"{d('temperature', 'avg_temperature_c')}, {d('soil', 'avg_soil_moisture')}, {i('n', 'event_count')}"
)


def drain_to_files(t, df):
    """Run a stream over all of its input and read the files it appended."""
    out = new_folder(t.spark, "stream")
    run_together([to_files(df, out, new_folder(t.spark, "checkpoint"), trigger=None)])
    return t.spark.read.schema(df.schema).parquet(out)


@query(
    "sink_stream_files",
    sql(f"SELECT {TUMBLING_COLUMNS} FROM w WHERE {closed('30 minutes')}", "readings", w=TUMBLING_3H),
)
def stream_files(t):
    return drain_to_files(t, windows.tumbling_3h(t.event_stream()))


def drained_sink(t) -> OnsetSink:
    sink = OnsetSink(t.spark, new_folder(t.spark, "onset"), now=lambda: F.lit(NOW).cast("timestamp"))
    totals = windows.totals_72h(t.event_stream())
    run_together([to_onset_sink(totals, sink, new_folder(t.spark, "checkpoint"), trigger=None)])
    return sink


CLOSED_72H = f"SELECT * FROM windows_72h WHERE {closed('2 hours')}"


@query(
    "sink_batch_append",
    sql(
        f"""SELECT county, {ts("window_start", "window_start")}, {d("cum_72hr_mm", "cum_72hr_mm")}, {i("event_count", "event_count")}, onset_flag FROM done""",
        "readings",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
    ),
)
def batch_append(t):
    rows = t.spark.read.parquet(f"{drained_sink(t).root}/onset_alerts")
    return rows.select("county", "window_start", "cum_72hr_mm", "event_count", "onset_flag")


PAYLOAD = "county string, alert_timestamp timestamp, cum_72hr_mm double, onset_flag boolean"


def _opened(texts):
    return texts.select(F.inline(F.array(F.from_json("value", PAYLOAD))))


@query(
    "stream_foreach_multi_sink",
    sql(
        f"""SELECT 'alert' AS sink, county, {ts("window_end", "alert_timestamp")}, {d("cum_72hr_mm", "cum_72hr_mm")} FROM done WHERE onset_flag
        UNION ALL SELECT 'snapshot', county, {ts("max(window_end)", "alert_timestamp")}, {d("arg_max(cum_72hr_mm, window_end)", "cum_72hr_mm")}
        FROM done WHERE onset_flag GROUP BY county""",
        "readings",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
    ),
)
def foreach_multi_sink(t):
    """The alert payloads and the snapshot that one drained stream left behind."""
    sink = drained_sink(t)
    alerts = _opened(t.spark.read.text(f"{sink.root}/payloads")).withColumn("sink", F.lit("alert"))
    latest = sink.snapshots.read().withColumn("sink", F.lit("snapshot"))
    columns = ["sink", "county", "alert_timestamp", "cum_72hr_mm"]
    return alerts.select(*columns).unionByName(latest.select(*columns))


@query(
    "stream_top_counties",
    sql(
        f"""SELECT county, {ts("window_end", "window_end")}, {d("cum_72hr_mm", "cum_72hr_mm")}, onset_flag FROM
        (SELECT *, row_number() OVER (ORDER BY cum_72hr_mm DESC, county) AS k FROM
          (SELECT *, row_number() OVER (PARTITION BY county ORDER BY cum_72hr_mm DESC, window_end DESC) AS j FROM done) WHERE j = 1)
        WHERE k <= 5""",
        "readings",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
    ),
)
def top_counties(t):
    """The report of a drained stream: one batch holds all of its windows."""
    rows = t.spark.read.parquet(f"{drained_sink(t).root}/top_counties")
    return rows.select("county", "window_end", "cum_72hr_mm", "onset_flag")


@query(
    "stream_cms_update",
    sql(
        f"SELECT {i('row_id', 'row_id')}, {i('col_id', 'col_id')}, {i('sum(n)', 'cnt')} FROM hashed GROUP BY row_id, col_id",
        "readings",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
        counts="SELECT county AS key, sum(event_count) AS n FROM done GROUP BY county",
        hashed=_cells_sql(DEFAULT, "counts"),
    ),
)
def cms_update(t):
    return drained_sink(t).sketch_cells()


@query(
    "stream_cms_top",
    sql(
        f"""SELECT key AS county, {i("estimate", "estimate")} FROM estimates ORDER BY estimate DESC, key LIMIT 5""",
        "readings",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
        **_sketch_ctes(DEFAULT, "SELECT county AS key, sum(event_count) AS n FROM done GROUP BY county"),
    ),
)
def cms_top(t):
    """The counties of most events by the sketch, of those that the summary of frequent keys holds: the
    report of a drained stream, without given candidates."""
    rows = t.spark.read.parquet(f"{drained_sink(t).root}/top_estimates")
    return rows.select("county", "estimate")


@query(
    "stream_heavy_hitters",
    sql(
        f"SELECT county AS key, {i('sum(event_count)', 'low')}, {i('sum(event_count)', 'high')} FROM done GROUP BY county",
        "readings",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
    ),
)
def heavy_counties(t):
    """Bounds of the events of each frequent county; with fewer counties than counters they meet."""
    return heavy_keys(drained_sink(t).frequent.read())


@query(
    "join_live_vs_baseline_stream",
    sql(
        f"""SELECT w.county, {ts("window_start", "window_start")}, {d("w.cum_72hr_mm", "cum_72hr_mm")}, {d("expected_mm", "expected_mm")},
        {d("w.cum_72hr_mm - expected_mm", "difference_mm")}, {d("w.cum_72hr_mm / expected_mm", "ratio")}
        FROM done w LEFT JOIN baseline b ON w.county = b.county AND month(w.window_start) = b.month""",
        "readings",
        "history",
        windows_72h=common.WINDOWS_72H,
        done=CLOSED_72H,
        baseline="SELECT county, month(observation_date) AS month, avg(cum_72hr_mm) AS expected_mm FROM history GROUP BY ALL",
    ),
)
def live_vs_baseline_stream(t):
    """Every closed window of a drained stream against the baseline read in its batch."""
    sink = BaselineSink(new_folder(t.spark, "baseline"), t.history)
    run_together([to_baseline_sink(windows.totals_72h(t.event_stream()), sink, new_folder(t.spark, "checkpoint"), trigger=None)])
    rows = t.spark.read.parquet(sink.root)
    return rows.select("county", "window_start", "cum_72hr_mm", "expected_mm", "difference_mm", "ratio")


@query(
    "sink_kafka_alerts",
    sql(
        f"""SELECT county, {ts("window_end", "alert_timestamp")}, {d("cum_72hr_mm", "cum_72hr_mm")}, onset_flag FROM windows_72h WHERE onset_flag""",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def kafka_alerts(t):
    """The message bodies, parsed back."""
    alerts = common.windows_72h(t).filter("onset_flag").withColumn("alert_timestamp", F.col("window_end"))
    return _opened(writers.alert_payloads(alerts))


@query(
    "sink_upsert_latest",
    sql(
        f"""SELECT county, {ts("max(window_end)", "alert_timestamp")}, {d("arg_max(cum_72hr_mm, window_end)", "cum_72hr_mm")},
        arg_max(onset_flag, window_end) AS onset_flag,
        CASE WHEN max(window_end) > TIMESTAMP '2024-01-20' THEN '2024-02-08 00:00:00' ELSE '2024-01-28 00:00:00' END AS expires_at,
        CASE WHEN max(window_end) > TIMESTAMP '2024-01-20' THEN '2024-02-01 00:00:00' ELSE '2024-01-21 00:00:00' END AS ingested_at
        FROM windows_72h WHERE min_precipitation > 0 GROUP BY county""",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def upsert_latest(t):
    """Two upserts, the later alerts last; every wet window counts as an alert."""
    alerts = common.windows_72h(t).filter("min_precipitation > 0")
    alerts = alerts.withColumn("alert_timestamp", F.col("window_end"))
    late = F.col("window_end") > F.lit("2024-01-20").cast("timestamp")
    empty = t.spark.createDataFrame([], SNAPSHOT)
    first = writers.upsert_latest(empty, alerts.filter(~late), F.lit("2024-01-21").cast("timestamp"))
    return writers.upsert_latest(first, alerts.filter(late), F.lit(NOW).cast("timestamp"))


@query("sink_parquet_overwrite", sql(FEATURES_SQL, "climate"))
def parquet_overwrite(t):
    path, rows = new_folder(t.spark, "features"), climate_features(t.climate())
    writers.overwrite_parquet(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "sink_table_replace",
    sql(f"SELECT observation_id, county, {d('cum_72hr_mm', 'cum_72hr_mm')}, onset_flag FROM history", "history"),
)
def table_replace(t):
    table = f"{writers.table_name_for('Onset-History.grib')}_{uuid.uuid4().hex}"
    writers.replace_table(t.history().drop("observation_date"), table, new_folder(t.spark, table))
    return t.spark.table(table)


@query(
    "sink_ctas_enriched",
    sql(
        f"SELECT id1, id2, {COUNTY_SQL} AS county, {d('temperature_c', 'y')}, {d('temperature_c + 273.15', 'temp_k')} FROM climate",
        "climate",
    ),
)
def ctas_enriched(t):
    coords = t.climate().select("lat", "lon").distinct()
    mapping = coords.withColumn("county", county_from_coord(F.col("lat"), F.col("lon")))
    y = F.col("temperature_c")
    rows = enrich_with_county(t.climate(), mapping).select(
        "id1", "id2", "county", y.alias("y"), (y + 273.15).alias("temp_k")
    )
    table = f"enriched_data_{uuid.uuid4().hex}"
    writers.replace_table(rows, table, new_folder(t.spark, table))
    return t.spark.table(table)


@query(
    "sink_raw_archive",
    sql(
        f"""SELECT county, '2024-02-01' AS date, {i("payload_id", "payload_id")}, {i("max(n)", "hours")},
        CASE WHEN max(n) >= 72 THEN 'ok' ELSE 'insufficient_data' END AS onset_signal, '2024-02-01T00:00:00Z' AS fetched_at
        FROM weeks GROUP BY county, payload_id""",
        "readings",
        hourly=common.HOURLY,
        weeks=common.WEEK_ROWS,
    ),
)
def raw_archive(t):
    payloads, path = common.week_payloads(t), new_folder(t.spark, "archive")
    writers.archive_raw(payloads, path, "forecast", F.lit(NOW).cast("timestamp"), "2024-02-01")
    schema = (
        "payload_id bigint, hourly struct<time: array<string>>, onset_signal string, "
        "_meta struct<county: string, fetched_at: string, source: string>, county string, date date"
    )
    return t.spark.read.schema(schema).json(path).select(
        "county",
        "date",
        "payload_id",
        F.size("hourly.time").alias("hours"),
        "onset_signal",
        F.col("_meta.fetched_at").alias("fetched_at"),
    )


@query("sink_csv_report", LATENCY_SQL)
def csv_report(t):
    report, path = latency_summary(t.raw("events"), "event_type", "value"), new_folder(t.spark, "report")
    writers.write_csv_report(report, path)
    return t.spark.read.schema(report.schema).csv(path, header=True)
