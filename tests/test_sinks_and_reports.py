"""Snapshots, tables, reports, filters, joins and quality checks."""

import pytest
from pyspark.sql import functions as F

from pluvia.operators import aggregates, filters, joins, quality, windows
from pluvia.operators.onset import onset_by_rows, onset_trailing
from pluvia.schemas import SNAPSHOT
from pluvia.sinks import writers
from pluvia.sources import files, payloads


def at(text):
    return F.lit(text).cast("timestamp")


def alerts(spark, *data):
    df = spark.createDataFrame(list(data), "county string, t string, cum_72hr_mm double, onset_flag boolean")
    return df.withColumn("alert_timestamp", F.col("t").cast("timestamp")).drop("t")


def test_snapshot_versions(spark, tmp_path):
    store = writers.SnapshotStore(spark, str(tmp_path / "s"))
    assert store.read().count() == 0
    store.upsert(alerts(spark, ("Meru", "2024-01-04", 21.0, True), ("Meru", "2024-01-07", 22.0, True)), "r", 0, at("2024-01-08"))
    store.upsert(alerts(spark, ("Embu", "2024-01-07", 30.0, True), ("Meru", "2024-01-05", 99.0, True)), "r", 1, at("2024-01-09"))
    got = {r["county"]: r["cum_72hr_mm"] for r in store.read().collect()}
    assert got == {"Meru": 22.0, "Embu": 30.0}
    store.upsert(alerts(spark, ("Embu", "2024-01-07", 30.0, True), ("Meru", "2024-01-05", 99.0, True)), "r", 1, at("2024-01-09"))
    assert {r["county"]: r["cum_72hr_mm"] for r in store.read().collect()} == got
    assert store.read().schema.names == SNAPSHOT.names
    alive = filters.unexpired(store.read(), at("2024-01-15 12:00:00"))
    assert [r["county"] for r in alive.collect()] == ["Embu"]


def test_payload_text(spark):
    text = writers.alert_payloads(alerts(spark, ("Meru", "2024-01-04", 21.0, True))).first()[0]
    assert text.startswith('{"county":"Meru","alert_timestamp":"2024-01-04T00:00:00') and '"onset_flag":true' in text


def test_table_name():
    assert writers.table_name_for("Era5-Land_2023.grib") == "era5_land_2023"


def test_replace_table_twice(spark, tmp_path):
    for i in (1, 2):
        writers.replace_table(spark.range(i), "replaced", str(tmp_path / "t"))
    assert spark.table("replaced").count() == 2
    spark.sql("DROP TABLE replaced")


def test_merge_prefers_batch(spark):
    schema = "county string, window_start string, v double"
    batch = spark.createDataFrame([("Meru", "a", 1.0)], schema)
    speed = spark.createDataFrame([("Meru", "a", 9.0), ("Meru", "b", 2.0)], schema)
    got = sorted(tuple(r) for r in joins.merge_batch_and_speed(batch, speed).collect())
    assert got == [("Meru", "a", 1.0, "batch"), ("Meru", "b", 2.0, "speed")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_start_no_job_and_leave_the_choice_to_measured_bytes(spark):
    fact, dim = spark.range(100).withColumn("k", F.col("id") % 5), spark.range(5).withColumnRenamed("id", "k")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("joins", "")
    try:
        joined = joins.join_checked(fact, dim.groupBy("k").count(), ["k"])
        assert not tracker.getJobIdsForGroup("joins")
        assert joined.count() == 100 and "isFinalPlan" in plan(joined)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_versions_of_a_new_run_follow_those_of_the_old(spark, tmp_path):
    """Two slots hold the state, however many versions there were; an expired county goes."""
    store = writers.SnapshotStore(spark, str(tmp_path / "s"))
    for batch in range(4):
        store.upsert(alerts(spark, ("Meru", f"2024-01-0{batch + 1}", 21.0, True)), "001-a", batch, at("2024-01-08"))
    store.upsert(alerts(spark, ("Embu", "2024-01-02", 30.0, True)), "002-b", 0, at("2024-01-09"))
    assert {r["county"]: r["alert_timestamp"].day for r in store.read().collect()} == {"Meru": 4, "Embu": 2}
    again = writers.SnapshotStore(spark, str(tmp_path / "s"))
    again.upsert(alerts(spark, ("Embu", "2024-01-02", 30.0, True)), "002-b", 0, at("2024-01-09"))
    assert again.read().count() == 2
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["slot=0", "slot=1"]
    again.upsert(alerts(spark), "002-b", 1, at("2024-01-15 12:00:00"))
    assert [r["county"] for r in again.read().collect()] == ["Embu"]
    again.upsert(alerts(spark), "002-b", 2, at("2024-02-15"))
    assert again.read().count() == 0


def test_a_repeated_archive_job_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("Meru", (["2024-01-01T00:00"], [1.0]))], "county string, hourly struct<time: array<string>, precipitation: array<double>>")
    for run in ("a", "a", "b"):
        writers.archive_raw(rows, str(tmp_path / "x"), "forecast", at("2024-01-08"), run)
    assert spark.read.json(str(tmp_path / "x")).count() == 2


def test_absent_fields_are_null(spark):
    rows = spark.createDataFrame([("Meru", (["2024-01-01T00:00"], [1.0]))], "county string, hourly struct<time: array<string>, precipitation: array<double>>")
    got = payloads.hourly_rows(rows).first()
    assert got["precipitation"] == 1.0 and got["wind_speed"] is None
    text = spark.createDataFrame([("Meru", '{"hourly": {"time": ["t"], "precipitation": [2.0], "surface_pressure": [990.0]}}')], "county string, payload string")
    parsed = payloads.trailing_snapshot(payloads.parse_payload(text, "payload", "hourly")).first()
    assert parsed["pressure_hpa"] == 990.0 and parsed["cum_72hr_mm"] == 2.0


def test_station_opens_one_folder_and_newest_files_are_few(spark, tmp_path):
    rows = spark.range(60).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("county"))
    path = str(tmp_path / "by")
    writers.overwrite_parquet(rows, path, ("county",))
    one = filters.by_station(spark.read.parquet(path), "c1")
    assert "PartitionFilters: [isnotnull(county" in plan(one) and one.count() == 20
    parts = str(tmp_path / "parts")
    for k in range(4):
        rows.filter(F.col("id") % 4 == k).coalesce(1).write.mode("append").parquet(parts)
    newest = files.newest_n_files(rows, parts, 2)
    assert {r["id"] % 4 for r in newest.collect()} == {2, 3} and len(newest.inputFiles()) == 2
    assert files.newest_n_files(rows, parts, 0).count() == 0


def test_years_and_trailing_days_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame([(1, "1996-06-01"), (2, "2001-07-01")], "id int, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz")
    ).write.parquet(path)
    df = spark.read.parquet(path)
    years = filters.by_years(df, 1996, 1999, "t")
    recent = filters.trailing_days(df, "t", "2001-08-01 10:00:00", 31)
    assert [r["id"] for r in years.collect()] == [1] and [r["id"] for r in recent.collect()] == [2]
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t," in plan(years) and "GreaterThanOrEqual(t," in plan(recent)


def test_trend_limits(spark):
    df = spark.createDataFrame([], "observation_date timestamp, county string, cum_72hr_mm double, onset_flag boolean")
    assert aggregates.historical_trend(df, "2024-01-01", 365).count() == 0
    with pytest.raises(ValueError):
        aggregates.historical_trend(df, "2024-01-01", 366)


def readings(spark, values):
    data = [("Meru", 3600 * i, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "county string, s bigint, reading_id bigint, precipitation double")
    return df.withColumn("event_time", F.timestamp_seconds("s"))


@pytest.mark.parametrize("limit", [10**9, 9])
@pytest.mark.parametrize(
    "values, starts",
    [
        ([20 / 72] * 71, []),
        ([0.5] * 72, [0]),
        ([0.5] * 40 + [None] + [0.5] * 80, [41, 42, 43, 44, 45, 46, 47, 48, 49]),
        ([0.27] * 74, []),
        ([0.5] * 72 + [0.0] + [0.5] * 72, [0, 73]),
    ],
)
def test_row_rule(spark, limit, values, starts):
    got = sorted(r["window_start"] for r in onset_by_rows(readings(spark, values), rows_per_task=limit).collect())
    assert got == [s for s in starts if s + 72 <= len(values)]


def test_row_rule_at_the_exact_threshold(spark):
    values = [0.1, 0.2, 0.3, 0.4] * 18  # 18.0 in decimals
    assert onset_by_rows(readings(spark, values), threshold=18.0).count() == 1
    assert onset_by_rows(readings(spark, values), threshold=18.000001).count() == 0


def test_trailing_rule(spark):
    rows = {r["hour"].day * 24 + r["hour"].hour: r for r in onset_trailing(readings(spark, [0.0] * 24 + [0.5] * 72)).collect()}
    last = rows[max(rows)]
    assert last["cum_72hr_mm"] == 36.0 and last["zero_hours_48"] == 0 and last["onset_flag"]
    earlier = rows[max(rows) - 30]
    assert earlier["zero_hours_48"] == 48 - 42 and not earlier["onset_flag"]


def test_breaches_need_consecutive_minutes(spark):
    data = [("a", m, 600.0) for m in (1, 2, 3, 4, 5, 8, 9)] + [("a", 6, 500.0)]
    df = spark.createDataFrame(data, "endpoint string, m bigint, p95 double")
    df = df.withColumn("minute", F.timestamp_seconds(F.col("m") * 60))
    got = quality.sustained_breaches(df, ["endpoint"], 500.0, 5).collect()
    assert [(r["breach_start"].minute, r["breach_end"].minute, r["intervals"]) for r in got] == [(1, 5, 5)]


def test_time_gaps(spark):
    df = spark.createDataFrame([("a", h) for h in (0, 6, 13, 14)], "k string, h bigint")
    df = df.withColumn("t", F.timestamp_seconds(F.col("h") * 3600))
    got = quality.time_gaps(df, "k", "t", 6).collect()
    assert [(r["gap_start"].hour, r["gap_end"].hour, r["gap_hours"]) for r in got] == [(6, 13, 7.0)]
    with pytest.raises(ValueError):
        quality.time_gaps(df, "k", "t", 0)


def test_histogram_of_one_value_and_latest(spark):
    assert [tuple(r) for r in aggregates.histogram(spark.range(3).selectExpr("2.0D as v"), "v").collect()] == [(0, 2.0, 3)]
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 6), ("a", 3, 7), (None, 1, 8)], "k string, t int, id int")
    got = windows.latest_per(df, ["k"], ["t", "id"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [("a", 3, 7), (None, 1, 8)]


def test_anomaly_scopes(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 60)], "county string, year int, onset_doy int")
    whole = sorted(r["anomaly"] for r in windows.onset_anomaly(df).collect())
    own = sorted(r["anomaly"] for r in windows.onset_anomaly(df, "a").collect())
    assert whole == [-20.0, -10.0, 30.0] and own == [-5.0, 5.0]
    assert sorted(r["anomaly"] for r in windows.onset_anomaly_by_county(df).collect()) == [-5.0, 0.0, 5.0]


def test_error_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 2.0), ("b", 2.0, 2.0)], "k string, y double, yhat double")
    got = {r["k"]: r for r in aggregates.error_metrics(df, ["k"]).collect()}
    assert got["a"]["mae"] == 0.5 and got["a"]["r2"] == pytest.approx(0.5) and got["b"]["r2"] is None


def test_approximate_latency_is_close(spark):
    df = spark.range(1000).selectExpr("'a' as k", "cast(id as double) as v")
    exact = aggregates.latency_summary(df, "k", "v").first()
    near = aggregates.latency_summary_approx(df, "k", "v").first()
    assert exact["peak_latency_ms"] == 990.0 and abs(near["peak_latency_ms"] - 990.0) <= 2
    assert exact["scale"] == near["scale"] == 1000 and exact["avg_latency_ms"] == near["avg_latency_ms"]


def test_live_against_baseline(spark):
    live = spark.createDataFrame([("a", "2024-01-04", 30.0), ("b", "2024-01-04", 5.0)], "county string, t string, cum_72hr_mm double")
    live = live.withColumn("window_start", F.col("t").cast("timestamp")).drop("t")
    history = spark.createDataFrame(
        [("a", "1999-01-01", 10.0), ("a", "2000-01-20", 20.0), ("a", "2000-02-01", 99.0)], "county string, t string, cum_72hr_mm double"
    ).withColumn("observation_date", F.col("t").cast("timestamp"))
    got = {r["county"]: r for r in joins.live_vs_baseline(live, history).collect()}
    assert got["a"]["difference_mm"] == 15.0 and got["a"]["ratio"] == 2.0
    assert got["b"]["expected_mm"] is None and got["b"]["ratio"] is None
