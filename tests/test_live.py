"""Heavy hitters, the per-batch report, live lag, the live breach counter and the live baseline."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import quality
from pluvia.operators.filters import sample_fixed
from pluvia.operators.sketch import heavy_hitters, heavy_keys, merge_heavy
from pluvia.session import state_session
from pluvia.streaming.breaches import breach_session, interval_p95, sustained_breaches_live
from pluvia.streaming.jobs import BaselineSink, OffsetLog, OnsetSink, file_lag, message_lag, run_together, to_baseline_sink, to_files


@pytest.mark.parametrize("k", [4, 40, 4000])
def test_heavy_hitters_keep_their_bounds(spark, k):
    """Alone and merged: true counts within the bounds, and every key above N / (k + 1) held."""
    turn = np.random.default_rng(0)
    keys = [f"k{x}" for x in turn.zipf(1.3, 6000) % 700]
    true = collections.Counter(keys)
    rows = [(key, 1) for key in keys] + [(None, 5), ("zero", 0)]
    df = spark.createDataFrame(rows, "key string, n bigint").repartition(4).cache()
    parts = df.where("key < 'k3'"), df.where("not key < 'k3'")
    merged = merge_heavy(*[heavy_hitters(p, "key", k, "n") for p in parts], k=k)
    for summary in (heavy_hitters(df, "key", k, "n"), merged):
        held = {r["key"]: (r["low"], r["high"]) for r in heavy_keys(summary).collect()}
        assert len(held) <= k and all(low <= true[key] <= high for key, (low, high) in held.items())
        assert all(high - low <= len(keys) / (k + 1) for low, high in held.values())
        assert {key for key, n in true.items() if n > len(keys) / (k + 1)} <= set(held)
    assert heavy_keys(heavy_hitters(df.limit(0), "key", k)).count() == 0


def test_estimates_come_batch_by_batch(spark, tmp_path):
    """A batch that runs again changes nothing; a later one adds to the counts."""
    sink = OnsetSink(spark, str(tmp_path / "s"), now=lambda: F.lit("2024-02-01").cast("timestamp"), top=2, heavy=3)

    def batch(counts):
        rows = [(c, n, 30.0, 1.0) for c, n in counts.items()]
        df = spark.createDataFrame(rows, "county string, event_count bigint, cum_72hr_mm double, min_precipitation double")
        at = F.lit("2024-01-04").cast("timestamp")
        return df.withColumns({"window_start": at, "window_end": at})

    sink(batch({"Meru": 5, "Embu": 3, "Kitui": 1}), 0)
    sink(batch({"Meru": 5, "Embu": 3, "Kitui": 1}), 0)
    assert [tuple(r) for r in sink.estimates().collect()] == [("Meru", 5), ("Embu", 3)]
    sink(batch({"Kitui": 9}), 1)
    assert [tuple(r) for r in sink.estimates().collect()] == [("Kitui", 10), ("Meru", 5)]
    assert spark.read.parquet(f"{sink.root}/top_estimates").count() == 4


def test_message_lag(spark):
    rows = [
        ("q", 0, "s", None, '{"t": {"0": 5, "1": 0}}', '{"t": {"0": 9, "1": 4}, "u": {"0": 2000}}', 5),
        ("q", 1, "s", "x", '{"t": {"0": 9, "1": 4}, "u": {"0": 2000}}', '{"t": {"0": 9, "1": 4}, "u": {"0": 2000}}', 5),
        ("q", 2, "files", None, '{"logOffset": 1}', None, 5),
    ]
    made = message_lag(spark.createDataFrame(rows, "query string, batch bigint, source string, start string, end string, latest string, rows bigint"))
    got = {(r["batch"], r["topic"]): (r["lag"], r["status"]) for r in made.collect()}
    assert got == {(0, "t"): (8, "HEALTHY"), (0, "u"): (2000, "CRITICAL"), (1, "t"): (0, "HEALTHY"), (1, "u"): (0, "HEALTHY")}


def test_backlog_of_files_falls_to_none(spark, tmp_path):
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "c")
    spark.range(0, 50, 1, 5).write.parquet(feed)
    events = state_session(spark).readStream.schema("id bigint").option("maxFilesPerTrigger", 2).parquet(feed)
    log = OffsetLog()
    events.sparkSession.streams.addListener(log)
    try:
        query = to_files(events, str(tmp_path / "o"), checkpoint, "drain", trigger=None)
        run_together([query])
        assert log.heard_all_of(query)
    finally:
        events.sparkSession.streams.removeListener(log)
    got = file_lag(log.table(spark), checkpoint, feed).orderBy("batch").collect()
    assert [(r["rows"], r["files_read"], r["files_behind"]) for r in got] == [(20, 2, 3), (20, 4, 1), (10, 5, 0)]
    assert got[-1]["bytes_behind"] == 0 and got[0]["bytes_behind"] > got[1]["bytes_behind"] > 0
    log.flush(spark, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() >= 3 and not log.rows


def test_live_breaches_equal_the_batch_ones(spark, tmp_path):
    """In three runs of one checkpoint; gaps, quiet intervals and a run that nothing follows."""
    over = {"a": [0, 1, 2, 5, 6, 7, 8, 20, 21, 22], "b": [3, 4, 9, 10, 11, 30]}
    rows = [(k, m, 200.0) for k, minutes in over.items() for m in minutes] + [("a", 9, 1.0), ("b", 60, 1.0), ("c", 80, 500.0), ("a", 30, None)]
    df = spark.createDataFrame(rows, "endpoint string, minute int, value double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("minute") * 60 + 1_700_000_040))
    feed, out, checkpoint = (str(tmp_path / x) for x in ("feed", "out", "c"))
    for low, high in ((0, 7), (7, 25), (25, 99)):
        df.where((F.col("minute") >= low) & (F.col("minute") < high)).coalesce(1).write.mode("append").parquet(feed)
        events = breach_session(spark).readStream.schema(df.schema).parquet(feed)
        live = sustained_breaches_live(interval_p95(events, "ts", "endpoint", "value", "1 minute", "1 minute"), 120.0, 3)
        run_together([to_files(live, out, checkpoint, trigger=None)])
    got = spark.read.schema(live.schema).parquet(out)
    batch = quality.sustained_breaches(quality.latency_percentiles(df, "ts", "endpoint", "value"), ["endpoint"], 120.0, 3)
    columns = ["endpoint", "breach_start", "breach_end", "intervals", "worst_p95"]
    want = sorted(map(tuple, batch.select(*columns).collect()))
    assert len(want) == 4 and sorted(map(tuple, got.select(*columns).collect())) == want


def test_a_renewed_baseline_shows_in_the_next_batch(spark, tmp_path):
    base, feed, checkpoint = (str(tmp_path / x) for x in ("base", "feed", "c"))
    schema = "county string, window_start timestamp, cum_72hr_mm double"

    def renew(mm: float) -> None:
        rows = spark.createDataFrame([("Meru", mm)], "county string, cum_72hr_mm double")
        rows.withColumn("observation_date", F.lit("2020-01-05").cast("date")).coalesce(1).write.mode("overwrite").parquet(base)

    sink = BaselineSink(str(tmp_path / "out"), lambda: spark.read.parquet(base))
    for number, mm in enumerate((10.0, 40.0)):
        renew(mm)
        row = spark.createDataFrame([("Meru", 20.0 + number), ("Embu", 1.0)], "county string, cum_72hr_mm double")
        row.select("county", F.lit("2024-01-04").cast("timestamp").alias("window_start"), "cum_72hr_mm").coalesce(1).write.mode("append").parquet(feed)
        events = state_session(spark).readStream.schema(schema).parquet(feed)
        run_together([to_baseline_sink(events, sink, checkpoint, trigger=None)])
    got = spark.read.parquet(sink.root).where("county = 'Meru'").orderBy("cum_72hr_mm").collect()
    assert [(r["expected_mm"], r["difference_mm"], r["ratio"]) for r in got] == [(10.0, 10.0, 2.0), (40.0, -19.0, 21 / 40)]
    assert spark.read.parquet(sink.root).where("county = 'Embu' and expected_mm is null").count() == 2


def test_minute_sketches_merge_to_hours_within_their_bound(spark):
    """Three thousand values an hour and endpoint: ranks within twice the stated error; small groups exactly."""
    df = spark.range(60_000).select(
        F.timestamp_seconds(F.col("id") % 36_000 + 1_700_000_000).alias("ts"),
        F.concat(F.lit("e"), F.col("id") % 2).alias("endpoint"),
        F.when(F.col("id") % 97 != 0, (F.xxhash64("id") % 100_000).cast("double")).alias("value"),
    )
    minutes = quality.latency_sketches(df, "ts", "endpoint", "value").cache()
    got = {(r["start"], r["endpoint"]): r for r in quality.merged_latency(minutes).collect()}
    held = collections.defaultdict(list)
    for r in df.where("value is not null").select(F.date_trunc("hour", "ts").alias("hour"), "endpoint", "value").collect():
        held[r["hour"], r["endpoint"]].append(r["value"])
    assert set(got) == set(held)
    for key, values in held.items():
        values = np.sort(values)
        assert got[key]["events"] == len(values)
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert abs(np.searchsorted(values, got[key][name]) / len(values) - q) < 0.033
    assert quality.merged_latency(minutes.limit(0)).count() == 0


def test_fixed_samples_merge(spark):
    rows = spark.range(500).select(F.col("id"), F.when(F.col("id") % 5 != 4, F.concat(F.lit("k"), F.col("id") % 3)).alias("k")).cache()
    whole = sample_fixed(rows, "k", "id", 20, seed=3)
    assert {r["k"]: r["count"] for r in whole.groupBy("k").count().collect()} == {"k0": 20, "k1": 20, "k2": 20, None: 20}
    parts = [sample_fixed(rows.where(c), "k", "id", 20, seed=3) for c in ("id < 170", "id >= 170")]
    merged = sample_fixed(parts[0].unionByName(parts[1]), "k", "id", 20, seed=3)
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert sample_fixed(rows, "k", "id", 20, seed=4).exceptAll(whole).count() > 0
