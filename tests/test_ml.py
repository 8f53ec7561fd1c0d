"""Splits and models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import ml


def series(spark, n, key="a"):
    df = spark.range(n).withColumn("k", F.lit(key))
    return df.withColumn("ds", F.timestamp_seconds(F.col("id") * 21_600 + 1_600_000_000))


@pytest.mark.parametrize("limit", [10**9, 5])
@pytest.mark.parametrize("n", [1, 5, 13, 24])
def test_chrono_split(spark, n, limit):
    df = series(spark, n).unionByName(series(spark, 2 * n, "b"))
    for up, cut in ((False, lambda m: int(0.8 * m)), (True, lambda m: m - math.ceil(0.2 * m))):
        got = ml.chrono_split(df, ["k"], ["ds", "id"], round_test_up=up, rows_per_task=limit).collect()
        for key, m in (("a", n), ("b", 2 * n)):
            train = sorted(r["id"] for r in got if r["k"] == key and r["role"] == "train")
            assert train == list(range(cut(m)))


@pytest.mark.parametrize("n", [6, 17, 30])
def test_folds(spark, n):
    got = ml.time_series_folds(series(spark, n), ["k"], ["ds", "id"]).collect()
    size = n // 6
    for fold in range(5):
        start = n - (5 - fold) * size
        rows = [r for r in got if r["fold"] == fold]
        assert sorted(r["id"] for r in rows if r["role"] == "train") == list(range(start))
        assert sorted(r["id"] for r in rows if r["role"] == "test") == list(range(start, start + size))


def test_cutoff_keeps_about_the_share(spark):
    got = ml.chrono_cutoff(series(spark, 1000), ["k"], "ds").filter("role = 'train'").count()
    assert abs(got - 800) <= 5


def test_seasonal_model_recovers_a_known_curve(spark):
    seconds = F.unix_seconds("ds").cast("double") - ml.ORIGIN
    curve = 20 + 0.5 * seconds / ml.YEAR_SECONDS + 3 * F.sin(2 * math.pi * seconds / ml.YEAR_SECONDS)
    df = series(spark, 4 * 365 * 3).withColumn("y", curve)
    model = ml.SeasonalModel(yearly=2, prior=math.inf)
    fitted = model.fit(df, "k", "ds", "y")
    coef = fitted.first()["coef"]
    assert coef == pytest.approx([20, 0.5, 3, 0, 0, 0], abs=1e-3)
    worst = model.predict(df, fitted, "k", "ds").agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert worst < 1e-3
    future = model.forecast(fitted, "k", 12).orderBy("ds").collect()
    assert len(future) == 12 and all(r["ds"].day == 1 for r in future)
    assert all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in future)


def test_seasonal_model_equals_least_squares(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(size=200)
    values = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "id bigint, y double")
    df = series(spark, 200).join(values, "id")
    model = ml.SeasonalModel(yearly=0, daily=1, prior=math.inf)
    got = model.fit(df, "k", "ds", "y").first()
    t = np.arange(200) * 21_600 + 1_600_000_000 - ml.ORIGIN
    angle = 2 * np.pi * t / ml.DAY_SECONDS
    x = np.column_stack([np.ones(200), t / ml.YEAR_SECONDS, np.sin(angle), np.cos(angle)])
    coef, sse, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert got["coef"] == pytest.approx(coef.tolist(), rel=1e-4, abs=1e-4)
    assert got["sigma"] == pytest.approx(float(np.sqrt(sse[0] / 196)), rel=1e-6)


def test_a_short_series_supports_no_year(spark):
    """A month of noise: no yearly terms, and an interval that widens with the distance."""
    df = series(spark, 120).withColumn("y", F.rand(3) * 10)
    model = ml.SeasonalModel(yearly=3)
    fitted = model.fit(df, "k", "ds", "y")
    row = fitted.first()
    assert row["used"] == [True, True] + [False] * 6 and row["coef"][2:] == [0.0] * 6
    ahead = model.forecast(fitted, "k", 12).orderBy("ds").collect()
    widths = [r["yhat_upper"] - r["yhat_lower"] for r in ahead]
    assert widths == sorted(widths) and widths[-1] > 2 * widths[0]
    assert all(r["yhat_upper"] >= 0 and r["yhat_lower"] <= 10 for r in ahead)


def test_boosted_trees_learn_store_and_load(spark, tmp_path):
    df = series(spark, 300).withColumns(
        {"a": (F.col("id") % 7).cast("double"), "b": F.lit(1.0), "y": (F.col("id") % 7).cast("double") * 2}
    )
    model = ml.fit_boosted(df, ["a", "b"], trees=8, depth=3, step=0.3)
    mae = ml.score(model, df).agg(F.avg(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert mae < 0.8
    weights = {r["feature"]: r["importance"] for r in ml.feature_importance(df, model).collect()}
    assert weights["a"] > 0.99 and weights["b"] == 0.0
    ml.save_model(model, str(tmp_path / "m"))
    again = ml.score(ml.load_model(str(tmp_path / "m")), df).select("id", "yhat")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, ml.score(model, df).select("id", "yhat").collect()))
