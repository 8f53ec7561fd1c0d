"""Streaming windows: the batch form of each, and drained streams against closed windows."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pluvia.plans import common
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.sinks import TUMBLING_3H, TUMBLING_COLUMNS, closed, drain_to_files
from pluvia.plans.tables import sql
from pluvia.session import new_folder, state_session
from pluvia.sinks.writers import write_batch
from pluvia.streaming import windows
from pluvia.streaming.breaches import breach_session, interval_p95, sustained_breaches_live
from pluvia.streaming.jobs import OffsetLog, file_lag, run_together, to_files


@query("stream_tumbling_3h", sql(f"SELECT {TUMBLING_COLUMNS} FROM w", "readings", w=TUMBLING_3H))
def tumbling_3h(t):
    return windows.tumbling_3h(t.readings())


def _sliding(hours: int, slide: int) -> str:
    start = f"time_bucket(INTERVAL '{slide} hours', event_time, TIMESTAMP '1970-01-01') - to_hours({slide} * k)"
    return f"""SELECT county, ws AS window_start, ws + INTERVAL '{hours} hours' AS window_end, sum(precipitation) AS rain,
  avg(temperature) AS temperature, count(*) AS n
FROM (SELECT *, {start} AS ws FROM readings, range({hours // slide}) r(k)) GROUP BY ALL"""


SLIDING_24H, SLIDING_72H = _sliding(24, 1), _sliding(72, 6)
SPAN = f"{ts('window_start', 'window_start')}, {ts('window_end', 'window_end')}"
COLUMNS_24H = (
    f"county, {SPAN}, {d('rain', 'cum_precipitation_mm')}, {d('temperature', 'avg_temperature_c')}, {i('n', 'event_count')}"
)


@query("stream_sliding_24h_1h", sql(f"SELECT {COLUMNS_24H} FROM w", "readings", w=SLIDING_24H))
def sliding_24h(t):
    return windows.sliding_24h(t.readings())


@query(
    "stream_sliding_24h_1h_live",
    sql(f"SELECT {COLUMNS_24H} FROM w WHERE {closed('2 hours')}", "readings", w=SLIDING_24H),
)
def sliding_24h_live(t):
    return drain_to_files(t, windows.sliding_24h(t.event_stream()))


ONSET_COLUMNS = (
    f"county, {SPAN}, {d('cum_72hr_mm', 'cum_72hr_mm')}, {d('min_precipitation', 'min_precipitation')}, "
    f"{i('event_count', 'event_count')}, onset_flag"
)


@query(
    "stream_onset_72h",
    sql(f"SELECT {ONSET_COLUMNS} FROM windows_72h", "readings", windows_72h=common.WINDOWS_72H),
)
def onset_72h(t):
    return windows.onset_72h(t.readings())


@query(
    "stream_onset_72h_live",
    sql(
        f"SELECT {ONSET_COLUMNS} FROM windows_72h WHERE {closed('2 hours')}",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def onset_72h_live(t):
    return drain_to_files(t, windows.onset_72h(t.event_stream()))


@query(
    "stream_sliding_72h_6h",
    sql(
        f"""SELECT county, {SPAN}, {d("rain", "total_rainfall_72h")}, {d("temperature", "avg_temp_72h")},
        CASE WHEN rain >= 20 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS onset_alert FROM w""",
        "readings",
        w=SLIDING_72H,
    ),
)
def sliding_72h(t):
    return windows.sliding_72h(t.readings())


EXACT = """SELECT county, ws AS window_start, ws + INTERVAL 72 HOUR AS window_end, ws + INTERVAL 120 HOUR AS emit_end,
  sum(precipitation) FILTER (event_time < ws + INTERVAL 72 HOUR) AS s,
  count(*) FILTER (event_time >= ws + INTERVAL 72 HOUR AND precipitation = 0) AS z,
  sum(CASE WHEN event_time < ws + INTERVAL 72 HOUR THEN 1 END) AS n
FROM (SELECT *, time_bucket(INTERVAL '24 hours', event_time, TIMESTAMP '1970-01-01') - to_hours(24 * k) AS ws
      FROM readings, range(5) r(k)) GROUP BY ALL"""


@query(
    "stream_onset_exact48",
    sql(
        f"""SELECT county, {SPAN}, {d("s", "cum_72hr_mm")}, {i("z", "dry_after")}, {i("n", "event_count")},
        coalesce(s >= 20 AND z = 0, false) AS onset_flag
        FROM w WHERE {closed("2 hours").replace("window_end", "emit_end")}""",
        "readings",
        w=EXACT,
    ),
)
def onset_exact48(t):
    """The look-ahead rule on a real stream: two chained aggregations, emitted 48 h later."""
    return drain_to_files(t, windows.onset_exact(t.event_stream()))


@query(
    "stream_hourly_dedup",
    sql(
        f"""SELECT county, {ts("hour", "hour")}, reading_id, {d("precipitation", "precipitation")}
        FROM (SELECT *, date_trunc('hour', event_time) AS hour,
              row_number() OVER (PARTITION BY county, date_trunc('hour', event_time) ORDER BY event_time, reading_id) AS k FROM readings)
        WHERE k = 1""",
        "readings",
    ),
)
def hourly_dedup(t):
    return windows.dedup_hourly(t.readings()).select("county", "hour", "reading_id", "precipitation")


# A poller repeats the value of the hour each minute: here every reading carries it.
POLLED = "(CAST(floor(epoch(event_time) / 3600) AS BIGINT) % 7) * CAST(0.3 AS DOUBLE)"
POLLED_72H = f"""SELECT county, time_bucket(INTERVAL '72 hours', hour, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '72 hours', hour, TIMESTAMP '1970-01-01') + INTERVAL '72 hours' AS window_end,
  sum(rain) AS cum, count(*) AS n, sum(rain) >= 20 AND min(rain) > 0 AS flag
FROM (SELECT DISTINCT county, date_trunc('hour', event_time) AS hour, {POLLED} AS rain FROM readings) GROUP BY ALL"""
POLLED_COLUMNS = (
    f"county, {ts('window_start', 'window_start')}, {d('cum', 'cum_72hr_mm')}, {i('n', 'event_count')}, flag AS onset_flag"
)


def _polled(events):
    hours = F.floor(F.unix_seconds("event_time") / 3600)
    return events.withColumn("precipitation", (hours % 7) * F.lit(0.3))


def _onset_columns(rows):
    return rows.select("county", "window_start", "cum_72hr_mm", "event_count", "onset_flag")


@query("stream_dedup_onset_72h", sql(f"SELECT {POLLED_COLUMNS} FROM polled", "readings", polled=POLLED_72H))
def dedup_onset(t):
    """One reading per county and hour before the 72-hour rule, so that repeats do not count as rain."""
    return _onset_columns(windows.onset_72h_of_hours(_polled(t.readings())))


@query(
    "stream_dedup_onset_72h_live",
    sql(f"SELECT {POLLED_COLUMNS} FROM polled WHERE {closed('4 hours')}", "readings", polled=POLLED_72H),
)
def dedup_onset_live(t):
    """The same on a stream: duplicates dropped within the watermark, then the windows."""
    return _onset_columns(drain_to_files(t, windows.onset_72h_of_hours(_polled(t.event_stream()))))


PERIODS = ("2024-01-11", "2024-01-21")


def _periods(t) -> list:
    """The readings in three parts, one after the other in time."""
    first, second = (F.lit(day).cast("timestamp") for day in PERIODS)
    e, rows = F.col("event_time"), t.readings()
    return [rows.filter(e < first), rows.filter((e >= first) & (e < second)), rows.filter(e >= second)]


@query(
    "stream_recovery",
    sql(f"SELECT {TUMBLING_COLUMNS} FROM w WHERE {closed('30 minutes')}", "readings", w=TUMBLING_3H),
)
def recovery(t):
    """Three runs of one checkpoint with new input before each; the second fails after it has written a
    batch, and the third repeats that batch before it goes on."""
    feed, out, checkpoint = (new_folder(t.spark, x) for x in ("feed", "stream", "checkpoint"))
    for number, part in enumerate(_periods(t)):
        part.write.mode("append").parquet(feed)
        events = state_session(t.spark).readStream.schema(part.schema).parquet(feed)
        df = windows.tumbling_3h(events)

        def keep(batch, batch_id, fails=number == 1):
            write_batch(batch, out, "0", batch_id)
            if fails:
                raise RuntimeError("lost after writing")

        writer = df.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
        try:
            run_together([writer.trigger(availableNow=True).start()])
        except StreamingQueryException:
            if number != 1:
                raise
    return t.spark.read.schema(df.schema).parquet(out).select(*df.columns)


@query(
    "stream_replay",
    sql(
        f"SELECT {TUMBLING_COLUMNS} FROM w WHERE {closed('30 minutes')}",
        "readings",
        w=TUMBLING_3H.replace("FROM readings", f"FROM readings WHERE event_time >= TIMESTAMP '{PERIODS[0]}'"),
    ),
)
def replay(t):
    """A backfill with a fresh checkpoint from a later start, file by file in the order of time."""
    feed = new_folder(t.spark, "feed")
    for part in _periods(t):
        part.coalesce(1).write.mode("append").parquet(feed)
    reader = state_session(t.spark).readStream.schema(part.schema).option("maxFilesPerTrigger", 1)
    events = reader.parquet(feed).filter(F.col("event_time") >= F.lit(PERIODS[0]).cast("timestamp"))
    return drain_to_files(t, windows.tumbling_3h(events))


@query(
    "stream_concurrent",
    sql(
        f"""SELECT 'tumbling_3h' AS query, {i("count(*)", "windows")}, {d("sum(rain)", "rain")} FROM a WHERE {closed("30 minutes")}
        UNION ALL SELECT 'sliding_24h', {i("count(*)", "windows")}, {d("sum(rain)", "rain")} FROM b WHERE {closed("2 hours")}
        UNION ALL SELECT 'onset_72h', {i("count(*)", "windows")}, {d("sum(cum_72hr_mm)", "rain")} FROM windows_72h WHERE {closed("2 hours")}""",
        "readings",
        a=TUMBLING_3H,
        b=SLIDING_24H,
        windows_72h=common.WINDOWS_72H,
    ),
)
def concurrent(t):
    """Three queries over one source, run side by side."""
    events = t.event_stream()
    plans = {
        "tumbling_3h": (windows.tumbling_3h(events), "cum_precipitation_mm"),
        "sliding_24h": (windows.sliding_24h(events), "cum_precipitation_mm"),
        "onset_72h": (windows.onset_72h(events), "cum_72hr_mm"),
    }
    outs = {name: new_folder(t.spark, name) for name in plans}
    run_together(
        [
            to_files(df, outs[name], new_folder(t.spark, "checkpoint"), name, trigger=None)
            for name, (df, _) in plans.items()
        ]
    )
    report = None
    for name, (df, rain) in plans.items():
        rows = t.spark.read.schema(df.schema).parquet(outs[name])
        part = rows.agg(F.count(F.lit(1)).alias("windows"), F.sum(rain).alias("rain")).select(
            F.lit(name).alias("query"), "windows", "rain"
        )
        report = part if report is None else report.unionByName(part)
    return report


LATE = "reading_id % 50 = 0 AND event_time < TIMESTAMP '2024-01-10'"


@query(
    "stream_late_data",
    sql(
        f"SELECT {TUMBLING_COLUMNS} FROM w WHERE {closed('30 minutes')}",
        "readings",
        w=TUMBLING_3H.replace("FROM readings", f"FROM readings WHERE NOT ({LATE})"),
    ),
)
def late_data(t):
    """Some early readings arrive after all others: the watermark has passed, they are dropped."""
    feed, out, checkpoint = (new_folder(t.spark, x) for x in ("feed", "stream", "checkpoint"))
    late = F.expr(LATE)
    for part in (t.readings().filter(~late), t.readings().filter(late)):
        part.write.mode("append").parquet(feed)
        events = state_session(t.spark).readStream.schema(part.schema).parquet(feed)
        df = windows.tumbling_3h(events)
        run_together([to_files(df, out, checkpoint, trigger=None)])
    return t.spark.read.schema(df.schema).parquet(out)


@query(
    "metric_sustained_breach_live",
    sql(
        f"""SELECT endpoint, {ts("min(bucket)", "breach_start")}, {ts("max(bucket)", "breach_end")}, {i("count(*)", "intervals")}, {d("max(p95)", "worst_p95")}
        FROM (SELECT *, CAST(epoch(bucket) / 21600 AS BIGINT) - row_number() OVER (PARTITION BY endpoint ORDER BY bucket) AS island
              FROM (SELECT event_type AS endpoint, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS bucket,
                      quantile_cont(value, 0.95) AS p95 FROM events GROUP BY ALL) WHERE p95 > 120)
        GROUP BY endpoint, island
        HAVING count(*) >= 3 AND max(bucket) + INTERVAL '12 hours' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"""
    ),
)
def sustained_breach_live(t):
    """Breaches counted by a stateful stream in three runs of one checkpoint: those that have ended."""
    feed, out, checkpoint = (new_folder(t.spark, x) for x in ("feed", "breaches", "checkpoint"))
    samples = t.raw("events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    first, second = (F.lit(day).cast("timestamp") for day in PERIODS)
    for part in (F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second):
        samples.where(part).write.mode("append").parquet(feed)
        events = breach_session(t.spark).readStream.schema(samples.schema).parquet(feed)
        p95 = interval_p95(events, "ts", "event_type", "value", "6 hours", "10 minutes")
        live = sustained_breaches_live(p95, 120.0, 3, 21_600)
        run_together([to_files(live, out, checkpoint, trigger=None)])
    return t.spark.read.schema(live.schema).parquet(out)


@query(
    "stream_lag_live",
    sql(
        f"""SELECT {i("period", "batch")}, {i("count(*)", "rows")}, {i("period + 1", "files_read")}, {i("2 - period", "files_behind")}
        FROM (SELECT CASE WHEN event_time < TIMESTAMP '{PERIODS[0]}' THEN 0 WHEN event_time < TIMESTAMP '{PERIODS[1]}' THEN 1 ELSE 2 END AS period FROM readings)
        GROUP BY period""",
        "readings",
    ),
)
def lag_live(t):
    """Three files drained one by one: what each batch read and how many files it left behind it."""
    feed, checkpoint = new_folder(t.spark, "feed"), new_folder(t.spark, "checkpoint")
    for part in _periods(t):
        part.coalesce(1).write.mode("append").parquet(feed)
    events = state_session(t.spark).readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    log = OffsetLog()
    events.sparkSession.streams.addListener(log)
    try:
        drained = to_files(windows.tumbling_3h(events), new_folder(t.spark, "stream"), checkpoint, "drain", trigger=None)
        run_together([drained])
        log.heard_all_of(drained)
    finally:
        events.sparkSession.streams.removeListener(log)
    lag = file_lag(log.table(t.spark), checkpoint, feed).where(F.col("rows") > 0)
    return lag.select("batch", "rows", "files_read", "files_behind")
