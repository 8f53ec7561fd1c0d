"""Streams: equality with batch, late rows, restarts, sinks and failures."""

import os
import time

import pytest
from pyspark.sql import functions as F

from pluvia.operators.sketch import Sketch
from pluvia.session import shared_root, state_session
from pluvia.sources import messages
from pluvia.streaming import windows
from pluvia.streaming.jobs import (
    OnsetSink,
    ProgressLog,
    lag_report,
    run_together,
    to_console,
    to_files,
    to_onset_sink,
)

SCHEMA = "county string, event_time timestamp, precipitation double, temperature double, soil_moisture double"


class Feed:
    """A folder of parquet files, one per batch, with increasing file times."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path / "feed"), 0
        os.makedirs(self.path)

    def add(self, data):
        text = SCHEMA.replace("event_time timestamp", "event_time string")
        df = self.spark.createDataFrame(data, text)
        df = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
        staging = f"{self.path}-{self.n}"
        df.coalesce(1).write.parquet(staging)
        part = next(f for f in os.listdir(staging) if f.endswith(".parquet"))
        target = f"{self.path}/{self.n:03}.parquet"
        os.rename(f"{staging}/{part}", target)
        stamp = time.time() - 1000 + 10 * self.n
        os.utime(target, (stamp, stamp))
        self.n += 1

    def stream(self):
        return (
            state_session(self.spark).readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.path)
        )

    def batch(self):
        return self.spark.read.schema(SCHEMA).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def rain(county, at, mm, temp=20.0):
    return (county, at, mm, temp, 0.2)


def days(county, first, count, mm):
    return [rain(county, f"2024-01-{first + h // 24:02} {h % 24:02}:30:00", mm) for h in range(24 * count)]


def drain(df, path, checkpoint, **options):
    run_together([to_files(df, path, checkpoint, trigger=None, **options)])


def keyed(df):
    def near(x):
        return round(x, 6) if isinstance(x, float) else x

    return {(r["county"], r["window_start"]): {k: near(v) for k, v in r.asDict().items()} for r in df.collect()}


@pytest.mark.parametrize("plan", [windows.tumbling_3h, windows.sliding_24h, windows.onset_72h, windows.onset_exact, windows.sliding_72h])
def test_stream_equals_batch_on_closed_windows(spark, feed, tmp_path, plan):
    feed.add(days("Meru", 1, 4, 0.4) + days("Embu", 1, 4, 0.1))
    feed.add(list(reversed(days("Meru", 5, 4, 0.3))) + days("Embu", 5, 4, 0.0))
    feed.add(days("Meru", 9, 4, 0.2))
    out = str(tmp_path / "out")
    drain(plan(feed.stream()), out, str(tmp_path / "cp"))
    got, want = keyed(spark.read.parquet(out)), keyed(plan(feed.batch()))
    assert got and set(got) < set(want)
    assert got == {k: want[k] for k in got}
    newest = max(k[1] for k in got)
    assert all(k in got for k in want if k[1] < newest)


def test_exact_rule_differs_from_the_proxy(spark, feed):
    feed.add(days("Meru", 3, 3, 0.4) + days("Meru", 6, 1, 0.0) + days("Meru", 7, 4, 0.4))
    start = F.col("window_start") == F.lit("2024-01-03").cast("timestamp")
    exact = windows.onset_exact(feed.batch()).filter(start).first()
    assert exact["cum_72hr_mm"] == pytest.approx(28.8) and exact["dry_after"] == 24
    assert exact["onset_flag"] is False
    proxy = windows.onset_72h(feed.batch()).filter(F.col("cum_72hr_mm") >= 20).select("onset_flag", "min_precipitation")
    assert all(r["onset_flag"] == (r["min_precipitation"] > 0) for r in proxy.collect())


def test_late_rows_are_dropped(spark, feed, tmp_path):
    feed.add([rain("Meru", "2024-01-01 00:10:00", 1.0)])
    feed.add([rain("Meru", "2024-01-01 09:00:00", 1.0)])
    feed.add([rain("Meru", "2024-01-01 09:05:00", 1.0)])
    feed.add([rain("Meru", "2024-01-01 00:20:00", 50.0), rain("Meru", "2024-01-01 15:00:00", 1.0)])
    out = str(tmp_path / "out")
    log = ProgressLog()
    stream = windows.tumbling_3h(feed.stream())
    stream.sparkSession.streams.addListener(log)
    drain(stream, out, str(tmp_path / "cp"))
    first = spark.read.parquet(out).orderBy("window_start").first()
    assert first["cum_precipitation_mm"] == 1.0
    deadline = time.time() + 10
    while sum(r[4] for r in log.rows) == 0 and time.time() < deadline:
        time.sleep(0.2)
    stream.sparkSession.streams.removeListener(log)
    assert sum(r[4] for r in log.rows) == 1


def test_restart_resumes(spark, feed, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for first in (1, 5, 9):
        feed.add(days("Meru", first, 4, 0.3))
        drain(windows.tumbling_3h(feed.stream()), out, cp)
    whole = str(tmp_path / "whole")
    drain(windows.tumbling_3h(feed.stream()), whole, str(tmp_path / "cp2"))
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, spark.read.parquet(whole).collect()))


def test_dedup(spark, feed, tmp_path):
    feed.add([rain("Meru", f"2024-01-01 05:{m:02}:00", 2.0) for m in range(0, 60, 10)] + [rain("Meru", "2024-01-01 06:00:00", 1.0)])
    batch = windows.dedup_hourly(feed.batch()).collect()
    assert sorted(r["precipitation"] for r in batch) == [1.0, 2.0]
    out = str(tmp_path / "out")
    drain(windows.dedup_hourly(feed.stream()), out, str(tmp_path / "cp"))
    assert sorted(r["precipitation"] for r in spark.read.parquet(out).collect()) == [1.0, 2.0]


def test_onset_sink(spark, feed, tmp_path):
    """Alerts, snapshot, history and sketch from one query; running a batch again changes nothing."""
    feed.add(days("Meru", 1, 9, 0.4) + days("Embu", 1, 9, 0.1))
    feed.add(days("Meru", 10, 6, 0.5))
    published = []
    sink = OnsetSink(
        spark, str(tmp_path / "sink"), now=lambda: F.lit("2024-02-01").cast("timestamp"),
        publish=lambda df: published.append(df.count()), sketch=Sketch(width=50),
    )
    run_together([to_onset_sink(windows.totals_72h(feed.stream()), sink, str(tmp_path / "cp"), trigger=None)])
    history = spark.read.parquet(f"{sink.root}/onset_alerts")
    flagged = history.filter("onset_flag").count()
    assert 0 < flagged < history.count() and sum(published) == flagged
    snapshot = {r["county"]: r for r in sink.snapshots.read().collect()}
    assert set(snapshot) == {"Meru"}
    newest = history.filter("onset_flag").agg(F.max("window_end")).first()[0]
    assert snapshot["Meru"]["alert_timestamp"] == newest
    assert str(snapshot["Meru"]["expires_at"]) == "2024-02-08 00:00:00"
    exact = history.groupBy(F.col("county").alias("key")).agg(F.sum("event_count").alias("n"))
    got = {r["key"]: r["estimate"] for r in sink.sketch.query(sink.sketch_cells(), exact).collect()}
    assert all(got[r["key"]] >= r["n"] for r in exact.collect())

    before = (sorted(map(str, history.collect())), str(snapshot), sorted(map(str, sink.sketch_cells().collect())))
    last = history.agg(F.max("batch_id")).first()[0]
    again = history.filter(F.col("batch_id") == last).drop("run", "batch_id", "onset_flag", "alert_timestamp")
    rows = spark.createDataFrame(again.collect(), again.schema)
    sink(rows, last)
    history = spark.read.parquet(f"{sink.root}/onset_alerts")
    snapshot = {r["county"]: r for r in sink.snapshots.read().collect()}
    assert before == (sorted(map(str, history.collect())), str(snapshot), sorted(map(str, sink.sketch_cells().collect())))


def test_second_checkpoint_on_the_same_root(spark, feed, tmp_path):
    """Batch numbers start again with a new checkpoint; nothing of the first run is lost."""
    now, root = lambda: F.lit("2024-02-01").cast("timestamp"), str(tmp_path / "sink")
    feed.add(days("Meru", 1, 9, 0.4) + days("Embu", 1, 9, 0.1))
    first = OnsetSink(spark, root, now=now, sketch=Sketch(width=50))
    run_together([to_onset_sink(windows.totals_72h(feed.stream()), first, str(tmp_path / "c1"), trigger=None)])
    before = spark.read.parquet(f"{root}/onset_alerts").count()
    total = sum(r["cnt"] for r in first.sketch_cells().collect())
    feed.add(days("Kitui", 1, 12, 0.5))
    second = OnsetSink(spark, root, now=now, sketch=Sketch(width=50))
    run_together([to_onset_sink(windows.totals_72h(feed.stream()), second, str(tmp_path / "c2"), trigger=None)])
    history = spark.read.parquet(f"{root}/onset_alerts")
    assert history.select("run").distinct().count() == 2 and history.count() > before
    assert {r["county"] for r in second.snapshots.read().collect()} == {"Meru", "Kitui"}
    newest = {r["county"]: r["t"] for r in history.filter("onset_flag").groupBy("county").agg(F.max("window_end").alias("t")).collect()}
    assert {r["county"]: r["alert_timestamp"] for r in second.snapshots.read().collect()} == newest
    assert sum(r["cnt"] for r in second.sketch_cells().collect()) > total
    assert spark.read.parquet(f"{root}/top_counties").count() >= 4


def test_empty_batch_writes_nothing(spark, tmp_path):
    sink = OnsetSink(spark, str(tmp_path / "sink"))
    empty = windows.totals_72h(spark.createDataFrame([], SCHEMA))
    sink(empty, 3)
    assert sorted(os.listdir(sink.root)) == ["sketch", "snapshot"]


def test_failure_stops_the_others(spark, feed, tmp_path):
    feed.add([rain("Meru", "2024-01-01 00:10:00", 1.0)])
    healthy = to_files(windows.tumbling_3h(feed.stream()), str(tmp_path / "a"), str(tmp_path / "ca"), trigger="1 second")

    def explode(df, batch_id):
        raise RuntimeError("sink is down")

    broken = (
        feed.stream().writeStream.foreachBatch(explode).option("checkpointLocation", str(tmp_path / "cb")).start()
    )
    with pytest.raises(Exception, match="sink is down"):
        run_together([healthy, broken])
    assert not healthy.isActive


def test_console(spark, feed, tmp_path):
    feed.add([rain("Meru", "2024-01-01 00:10:00", 1.0)])
    query = to_console(feed.stream(), str(tmp_path / "cp"), trigger=None)
    query.awaitTermination(60)
    assert query.exception() is None


def test_text_stream_decodes(spark, tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    good = '{"county":"Meru","timestamp":"2024-01-01T00:00:00Z","precipitation":1.0}'
    (folder / "a.json").write_text(f"{good}\nnot json\n")
    raw = messages.message_stream(state_session(spark), "files", str(folder))
    out = str(tmp_path / "out")
    drain(messages.parse_messages(raw), out, str(tmp_path / "cp"))
    assert [r["county"] for r in spark.read.parquet(out).collect()] == ["Meru"]


@pytest.mark.parametrize("ends, lag, status", [([1500, 100], 1100, "CRITICAL"), ([1400, 0], 1000, "HEALTHY")])
def test_lag_report(spark, ends, lag, status):
    data = [("raw", 0, ends[0], 400), ("raw", 1, ends[1], 100 if ends[1] else None)]
    df = spark.createDataFrame(data, "topic string, partition int, end_offset bigint, committed_offset bigint")
    assert tuple(lag_report(df).first()) == ("raw", lag, status)


def test_shared_root_is_the_sessions(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
