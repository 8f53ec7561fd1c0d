"""Trend with changepoints: planted ones are found, the moments are those of the full design, intervals widen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import ml
from pluvia.operators.trend import TrendModel, descend

DAY = 86_400


@pytest.fixture(scope="module")
def series(spark):
    """Key a bends at 32 % and 64 % of 600 days, b is a line, c has one row, d is constant; a has gaps."""
    turn, rows = np.random.default_rng(0), []
    for k in range(601):
        t = k / 600
        bent = 10 + 20 * t - 50 * max(t - 0.32, 0) + 30 * max(t - 0.64, 0) + turn.normal() * 0.2
        rows += [("a", k, None if k % 50 == 7 else bent), ("b", k, 3 + 2 * t + turn.normal() * 0.1), ("d", k, 4.0)]
    rows += [("c", 5, 1.5), (None, 5, 1.0)]
    df = spark.createDataFrame(rows, "k string, day bigint, y double")
    return df.withColumn("ds", F.timestamp_seconds(F.col("day") * DAY + 1_500_000_000)).cache()


@pytest.fixture(scope="module")
def fitted(series):
    return TrendModel().fit(series, "k", "ds", "y").cache()


def test_planted_changes_are_found(series, fitted):
    found = TrendModel().changes(fitted.where("k = 'a'"), "k", least=5.0).orderBy("ds").collect()
    places = [(r["ds"].timestamp() - 1_500_000_000) / DAY / 600 for r in found]
    assert places == pytest.approx([0.32, 0.64], abs=0.033)
    assert [r["delta"] for r in found] == pytest.approx([-50, 30], rel=0.1)
    straight = TrendModel().changes(fitted.where("k = 'b'"), "k", least=0.2).count()
    assert straight == 0


def test_history_is_told_at_least_as_well_as_by_the_line(series, fitted):
    bent = TrendModel().predict(series, fitted, "k", "ds")
    line = ml.SeasonalModel(yearly=0)
    straight = line.predict(series, line.fit(series, "k", "ds", "y"), "k", "ds")
    error = F.avg((F.col("y") - F.col("yhat")) ** 2).alias("e")
    of_line = {r["k"]: r["e"] for r in straight.where("k is not null").groupBy("k").agg(error).collect()}
    for r in bent.where("k is not null").groupBy("k").agg(error).collect():
        assert r["e"] <= of_line[r["k"]] + 1e-9


def test_solution_equals_descent_on_the_full_design(series, fitted):
    """The optimality conditions on the rows themselves, not on moments."""
    model, row = TrendModel(), fitted.where("k = 'a'").first()
    held = series.where("k = 'a' and y is not null").orderBy("ds").collect()
    t = np.array([(r["ds"].timestamp() - row["start"]) / row["span"] for r in held])
    y, scale = np.array([r["y"] for r in held]), max(abs(r["y"]) for r in held)
    x = np.column_stack([np.ones(len(t)), t, *[np.maximum(t - p, 0) for p in model.places]])
    c = np.array([row["level"], row["slope"], *row["deltas"]]) / scale
    rest = y / scale - x @ c
    limit = np.mean(rest**2) / model.flexibility
    slope = x.T @ rest
    assert np.abs(slope[:2]).max() < 1e-6
    for d, s in zip(c[2:], slope[2:]):
        assert abs(s) <= limit * 1.001 if d == 0 else s == pytest.approx(limit * np.sign(d), rel=1e-2)


def test_descent_without_penalty_is_least_squares():
    turn = np.random.default_rng(2)
    x, y = turn.normal(size=(80, 6)), turn.normal(size=80)
    got = descend(x.T @ x, x.T @ y, np.array([0, 0, 1e-12, 1e-12, 1e-12, 1e-12]), np.zeros(6), np.ones(6, bool), np.zeros(6))
    assert got == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0], abs=1e-6)


def test_forecasts_widen_and_edges_hold(fitted):
    model = TrendModel()
    ahead = model.forecast(fitted, "k", 12).orderBy("k", "ds").collect()
    of = {k: [r for r in ahead if r["k"] == k] for k in "abcd"}
    widths = [r["yhat_upper"] - r["yhat_lower"] for r in of["a"]]
    assert len(widths) == 12 and widths == sorted(widths) and widths[-1] > widths[0]
    assert all(r["ds"].day == 1 for r in of["a"])
    assert all(r["yhat"] == pytest.approx(1.5) for r in of["c"]) and all(r["yhat"] == pytest.approx(4.0, abs=1e-4) for r in of["d"])


def test_seasons_beside_the_trend(spark):
    df = spark.range(24 * 40).withColumn("ds", F.timestamp_seconds(F.col("id") * 3600 + 1_600_000_000))
    angle = F.unix_seconds("ds") * (2 * np.pi / DAY)
    df = df.withColumns({"k": F.lit("x"), "y": 5 + F.col("id") / 500 + 2 * F.sin(angle) - F.cos(angle)})
    model = TrendModel(daily=1)
    fitted = model.fit(df, "k", "ds", "y")
    assert fitted.first()["season"] == pytest.approx([2, -1], abs=0.02)
    worst = model.predict(df, fitted, "k", "ds").agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert worst < 0.1
    assert model.fit(df.limit(0), "k", "ds", "y").count() == 0
