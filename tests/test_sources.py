"""Messages, payload arrays and grids."""

import pytest
from pyspark.sql import functions as F

from pluvia.schemas import MESSAGE_V0
from pluvia.sources import files, messages, payloads

GOOD = '{"county":"Meru","timestamp":"2025-04-01T08:00:00Z","precipitation":1.5,"temperature":20.0,"soil_moisture":0.2}'


def texts(spark, *values):
    return spark.createDataFrame([(v.encode(),) for v in values], "value binary")


def test_messages(spark):
    raw = texts(
        spark,
        GOOD,
        GOOD.replace("1.5", '"wet"'),
        GOOD.replace('"county":"Meru",', ""),
        "not json",
        GOOD.replace("2025-04-01T08:00:00Z", "bogus"),
        GOOD.replace("}", ',"extra":true}'),
    )
    kept = messages.parse_messages(raw).select("county", "precipitation").collect()
    assert sorted(map(tuple, kept), key=repr) == [("Meru", 1.5), ("Meru", 1.5), ("Meru", None)]
    reasons = sorted(r[0] for r in messages.rejected_messages(raw).select("reject_reason").collect())
    assert reasons == ["bad timestamp", "missing county", "no usable fields"]


def test_older_message_and_zone(spark):
    raw = texts(
        spark,
        '{"county":"Embu","timestamp":"2025-04-01T08:00","rainfall_mm":2.0,"temperature_c":19.5,"humidity":60}',
        '{"county":"Embu","timestamp":"2025-04-01T08:00Z","rainfall_mm":3.0}',
    )
    rows = messages.parse_messages(raw, MESSAGE_V0, "Africa/Nairobi").orderBy("precipitation").collect()
    assert [str(r["event_time"]) for r in rows] == ["2025-04-01 05:00:00", "2025-04-01 08:00:00"]
    assert (rows[0]["temperature"], rows[0]["soil_moisture"]) == (19.5, None)


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError):
        messages.message_stream(spark, "pigeon", "x")


def payload(spark, rain, **arrays):
    times = [f"h{i}" for i in range(len(rain))]
    schema = "payload_id int, hourly struct<time: array<string>, precipitation: array<double>, temperature_2m: array<double>, surface_pressure: array<double>>"
    row = (1, (times, rain, arrays.get("temperature"), arrays.get("pressure")))
    return spark.createDataFrame([row], schema)


@pytest.mark.parametrize(
    "rain, signal, flag, dry",
    [
        ([1.0] * 71, "insufficient_data", None, None),
        ([20 / 72] * 72, "ok", True, False),
        ([0.5] * 72 + [0.1, 0.0], "ok", False, True),
        ([0.5] * 168 + [0.0], "ok", True, False),
        ([0.1] * 72 + [0.5] * 10, "ok", False, False),
        ([0.5] * 72 + [None], "ok", True, False),
    ],
)
def test_forecast_onset(spark, rain, signal, flag, dry):
    # 20 / 72 summed 72 times is a hair off 20, as in any engine; nudge it over.
    rain = [x + 1e-12 if x else x for x in rain]
    row = payloads.forecast_onset(payload(spark, rain)).first()
    assert (row["onset_signal"], row["onset_flag"], row["dry_spell_detected"]) == (signal, flag, dry)
    if signal == "ok":
        assert (row["onset_window_start"], row["onset_window_end"]) == ("h0", "h71")


def test_trailing_snapshot(spark):
    temps = [float(i) for i in range(100)]
    row = payloads.trailing_snapshot(
        payload(spark, [100.0] * 28 + [1.0] * 70 + [None, 2.0], temperature=temps, pressure=[900.0, 0.0])
    ).first()
    assert row["cum_72hr_mm"] == 72.0
    assert (row["temp_c"], row["temp_lag_6h_c"], row["temp_lag_24h_c"]) == (99.0, 93.0, 75.0)
    assert row["pressure_hpa"] == 1013.0
    short = payloads.trailing_snapshot(payload(spark, [1.0], temperature=[5.0])).first()
    assert (short["cum_72hr_mm"], short["temp_lag_6h_c"], short["pressure_hpa"]) == (1.0, None, 1013.0)


def test_latest_and_hourly_from_text(spark):
    text = '{"hourly":{"time":["a","b"],"precipitation":[0.1,null],"temperature_2m":[1.0,2.00005]}}'
    df = payloads.parse_payload(spark.createDataFrame([("Meru", text)], "county string, p string"), "p", "hourly")
    last = payloads.latest_reading(df).first()
    assert (last["timestamp"], last["precipitation"], last["humidity"]) == ("b", 0.0, None)
    assert last["temperature"] == pytest.approx(2.0, abs=2e-4)
    hours = payloads.hourly_rows(df).orderBy("time").collect()
    assert [(r["time"], r["precipitation"], r["wind_speed"]) for r in hours] == [("a", 0.1, None), ("b", None, None)]


def test_daily_with_missing_arrays(spark):
    text = '{"daily":{"time":["2025-04-01","2025-04-02"],"precipitation_sum":[3.0,4.0]}}'
    df = payloads.parse_payload(spark.createDataFrame([("Meru", text)], "county string, p string"), "p", "daily")
    got = [tuple(r) for r in payloads.daily_rows(df).orderBy("date").collect()]
    assert got == [("Meru", "2025-04-01", 3.0, None, None), ("Meru", "2025-04-02", 4.0, None, None)]


def test_grid(spark):
    schema = "valid_time string, latitude array<double>, longitude array<double>, t array<array<double>>"
    cube = spark.createDataFrame([("d", [1.0, 2.0], [5.0, 6.0], [[10.0, None], [12.0, 13.0]])], schema)
    got = sorted(tuple(r) for r in payloads.flatten_grid(cube, "t", "k", keep=["valid_time"]).collect())
    assert got == [("d", 1.0, 5.0, 10.0), ("d", 2.0, 5.0, 12.0), ("d", 2.0, 6.0, 13.0)]


def test_scan_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.lit("x").alias("unused")).write.parquet(path)
    df = files.scan(spark, path, {"id": "ds", "v": "y"}).filter("ds > 90")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan and "unused" not in plan
    assert df.count() == 9


def test_newest_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    df = spark.read.parquet(path)
    assert files.newest_files(df, "2000-01-01").count() == 3
    assert files.newest_files(df, "2999-01-01").count() == 0
