"""Scores, labels and units on literal cases."""

import math

import pytest
from pyspark.sql import functions as F

from pluvia.functions import risk, weather
from pluvia.operators import serving
from pluvia.operators.ml import feature_vector
from pluvia.operators.windows import category_codes, with_category_code
from pluvia.schemas import COUNTIES, county_dim


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "lat, name, code",
    [(-1.0, "Coastal", 0), (-1.01, "Highland", 1), (-5.0, "Highland", 1), (-5.01, "Lake", 2),
     (-10.0, "Lake", 2), (-10.01, "Arid", 3), (None, "Arid", 3)],
)
def test_region_bands(spark, lat, name, code):
    c = F.lit(lat).cast("double")
    assert one(spark, F.struct(weather.region_band(c), weather.region_code(c))) == (name, code)


@pytest.mark.parametrize(
    "lat, lon, name",
    [(1.25, 36.75, "Nairobi"), (-4.0, 39.6, "Mombasa"), (3.5, 36.0, "Turkana"), (0.0, 0.0, "Region_0.0_0.0")],
)
def test_county_names(spark, lat, lon, name):
    assert one(spark, weather.county_from_coord(F.lit(lat), F.lit(lon))) == name


def test_seasons(spark):
    got = {r["id"]: r["s"] for r in spark.range(1, 13).select("id", weather.season(F.col("id")).alias("s")).collect()}
    assert [got[m] for m in range(1, 13)] == ["DJF"] * 2 + ["MAM"] * 3 + ["JJA"] * 3 + ["OND"] * 3 + ["DJF"]


def test_units(spark):
    row = one(
        spark,
        F.struct(
            weather.kelvin_to_celsius(F.lit(300.0)).alias("c"),
            weather.celsius_to_kelvin(F.lit(None).cast("double")).alias("neutral"),
            weather.celsius_to_fahrenheit(F.lit(100.0)).alias("f"),
            weather.temperature_bucket(F.lit(-0.5)).alias("b"),
            weather.step_hours(F.expr("interval '2 03:59:59' day to second")).alias("h"),
        ),
    )
    assert row["c"] == pytest.approx(26.85) and row["neutral"] == 295.15
    assert (row["f"], row["b"], row["h"]) == (212.0, -1, 51)


@pytest.mark.parametrize(
    "total, driest, flag",
    [(25.0, 0.1, True), (20.0, 0.1, True), (19.99, 0.1, False), (30.0, 0.0, False), (None, None, False)],
)
def test_onset_flag(spark, total, driest, flag):
    t, m = F.lit(total).cast("double"), F.lit(driest).cast("double")
    assert one(spark, risk.onset_flag(t, m)) is flag


def test_three_signal_golden(spark):
    score = risk.three_signal(F.lit(25.0), F.lit(0.6), F.lit(0.8))
    row = one(spark, F.struct(score.alias("s"), risk.band(score).alias("b")))
    assert row["s"] == pytest.approx(0.76) and row["b"] == "HIGH"


@pytest.mark.parametrize("score, level", [(0.7, "MODERATE"), (0.71, "HIGH"), (0.4, "LOW"), (0.41, "MODERATE")])
def test_band_edges(spark, score, level):
    assert one(spark, risk.band(F.lit(score))) == level


@pytest.mark.parametrize("total, score, level", [(20.0, 1.0, "HIGH"), (19.9, 0.0, "LOW")])
def test_two_signal_without_model(spark, total, score, level):
    s = risk.two_signal(F.lit(total), F.lit(None).cast("double"))
    assert one(spark, F.struct(s, risk.band(s))) == (score, level)


@pytest.mark.parametrize("total, score, level", [(10.0, 0.25, "LOW"), (19.0, 0.4, "LOW"), (20.0, 1.0, "WATCH")])
def test_rule_fallback(spark, total, score, level):
    c = F.lit(total)
    assert one(spark, F.struct(risk.rule_only(c), risk.alert_level(risk.rule_only(c), c >= 20))) == (score, level)


@pytest.mark.parametrize(
    "raw, want",
    [(["1.7"], 1.0), (["-0.2"], 0.0), (["NaN"], None), (["x"], None), ([], None), (None, None), (["0.3", "9"], 0.3)],
)
def test_normalise(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw array<string>")
    assert df.select(risk.normalise(F.col("raw"))).first()[0] == want


def test_local_model(spark):
    got = one(spark, risk.local_model(F.lit(0.3), F.lit(21.6)))
    soft = 1 / (1 + 2.71828 ** (-2 * ((0.3 * 72 - 10) / 20)))
    assert got == pytest.approx(0.33 + 0.67 * soft)


def test_round_mm_is_half_up(spark):
    assert one(spark, risk.round_mm(F.lit(15.394999999999998))) == 15.4
    assert not math.isclose(one(spark, risk.round_mm(F.lit(15.3949))), 15.4)


def test_category_codes_are_alphabetical_and_default_to_zero(spark):
    dim = county_dim(spark)
    codes = category_codes(dim, "county")
    got = {r["county"]: r["code"] for r in codes.collect()}
    assert got == {n: i for i, n in enumerate(sorted(n for n, _, _ in COUNTIES))}
    other = spark.createDataFrame([("Atlantis",), ("Nakuru",)], "county string")
    coded = {r[0]: r[1] for r in with_category_code(other, codes, "county", "c").collect()}
    assert coded == {"Atlantis": 0, "Nakuru": got["Nakuru"]}


def test_feature_vector_defaults(spark):
    df = spark.createDataFrame(
        [(None,) * 6], "y double, surface_pressure double, temp_k double, temp_lag_6h double, temp_lag_24h double, county_cat int"
    )
    assert tuple(feature_vector(df).first()) == (0.0, 1013.0, 295.15, 295.15, 295.15, 0.0)


def test_risk_map_and_envelope(spark):
    live = spark.createDataFrame(
        [("Meru", 25.0, True, "2024-01-04 00:00:00")], "county string, cum_72hr_mm double, onset_flag boolean, ts string"
    ).select("county", "cum_72hr_mm", "onset_flag", F.col("ts").cast("timestamp").alias("alert_timestamp"))
    scores = spark.createDataFrame([("Embu", 0.9)], "county string, ml_probability double")
    rows = serving.risk_map(county_dim(spark), live, scores)
    got = {r["county"]: r for r in rows.collect()}
    assert len(got) == 10
    assert (got["Meru"]["onset_risk_score"], got["Meru"]["onset_risk"]) == (1.0, "HIGH")
    assert (got["Embu"]["onset_risk_score"], got["Embu"]["onset_risk"]) == (0.603, "MODERATE")
    assert got["Kitui"]["cum_72hr_mm"] == 0.0 and got["Kitui"]["alert_timestamp"] is None
    assert serving.county_detail(rows, "Nowhere").count() == 0
    feature = serving.features(serving.county_detail(rows, "Kitui")).select(F.to_json("feature")).first()[0]
    assert '"coordinates":[38.0167,-1.3667]' in feature and "ml_probability" not in feature
    text = serving.feature_collection(rows, F.lit("now"), "v1").first()[0]
    assert '"feature_count":10' in text and '"speed_layer_docs":1' in text and '"ml_layer_active":true' in text
