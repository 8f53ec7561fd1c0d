"""Second-order boosting against a plain loop, Shapley values against all subsets, permutation and folds."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import boosting, ml
from pluvia.operators.boosting import Booster

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table():
    turn = np.random.default_rng(4)
    x = np.column_stack([turn.integers(0, 12, 400), turn.integers(0, 5, 400), turn.integers(0, 3, 400)]).astype(float)
    y = np.where(x[:, 0] > 5, 3.0, 0.0) + x[:, 1] * (x[:, 2] == 1) + turn.normal(size=400) * 0.1
    x[turn.random(400) < 0.1, 0] = np.nan
    y[np.isnan(x[:, 0])] += 5
    return x, y


@pytest.fixture(scope="module")
def df(spark, table):
    x, y = table
    rows = [(i, *(None if np.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, y double").repartition(3).cache()


def slow_predictions(x, y, booster):
    """Boosting by trying every cut and both ways for nulls; one list of rows per node."""
    p = np.full(len(y), y.mean())

    def grow(rows, level):
        g, h = (p - y)[rows].sum(), len(rows)
        best = (0.0, None)
        for f, v in itertools.product(range(x.shape[1]), sorted(set(x[~np.isnan(x)]))) if level < booster.depth else ():
            for left_nulls in (True, False):
                col = x[rows, f]
                if v not in col and v not in x[:, f]:
                    continue
                left = np.where(np.isnan(col), left_nulls, col < v)
                hl = left.sum()
                if not 1 <= hl <= h - 1:
                    continue
                gl = (p - y)[rows][left].sum()
                gain = round(0.5 * (gl**2 / (hl + booster.ridge) + (g - gl) ** 2 / (h - hl + booster.ridge) - g**2 / (h + booster.ridge)), 6)
                if gain > best[0]:
                    best = (gain, left)
        if best[1] is None:
            made[rows] = -booster.step * g / (h + booster.ridge)
            return
        grow(rows[best[1]], level + 1)
        grow(rows[~best[1]], level + 1)

    for _ in range(booster.trees):
        made = np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        p = p + made
    return p


@pytest.fixture(scope="module")
def model(df):
    return Booster(trees=4, depth=3, step=0.5).fit(df, FEATURES)


def test_boosting_equals_a_plain_loop(df, table, model):
    x, y = table
    got = np.array([r["yhat"] for r in boosting.score(model, df).orderBy("id").collect()])
    assert np.allclose(got, slow_predictions(x, y, Booster(trees=4, depth=3, step=0.5)), atol=1e-9)
    assert np.sqrt(np.mean((got - y) ** 2)) < 0.5 * y.std()


def test_trees_written_between_give_the_same(df, model, monkeypatch):
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    again = Booster(trees=4, depth=3, step=0.5).fit(df, FEATURES)
    assert [t.feature for t in again.trees] == [t.feature for t in model.trees]
    assert np.allclose([t.value for t in again.trees], [t.value for t in model.trees])


def test_store_and_load(spark, df, model, tmp_path):
    boosting.save(model, spark, str(tmp_path / "m"))
    again = boosting.load(spark, str(tmp_path / "m"))
    assert again == model


def slow_shapley(model, row):
    """Every subset of features; a feature outside it takes both ways by their share of training rows."""

    def value(tree, known, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        left, right = 2 * node + 1, 2 * node + 2
        if f in known:
            goes_left = tree.nulls_left[node] if np.isnan(row[f]) else row[f] < tree.cut[node]
            return value(tree, known, left if goes_left else right)
        return (tree.cover[left] * value(tree, known, left) + tree.cover[right] * value(tree, known, right)) / tree.cover[node]

    m, out = len(row), []
    for f in range(m):
        others = [k for k in range(m) if k != f]
        phi = 0.0
        for size in range(m):
            weight = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
            for held in itertools.combinations(others, size):
                phi += weight * sum(value(t, {*held, f}) - value(t, set(held)) for t in model.trees)
        out.append(phi)
    return out


def test_shapley_values_equal_all_subsets(df, table, model):
    x, _ = table
    got = boosting.shapley_values(model, df).orderBy("id").collect()
    for k in range(0, 400, 23):
        assert [got[k][f"phi_{f}"] for f in FEATURES] == pytest.approx(slow_shapley(model, x[k]), abs=1e-9)
    for r in got:
        assert sum(r[f"phi_{f}"] for f in FEATURES) == pytest.approx(r["yhat"] - r["expected"], abs=1e-9)
    summary = {r["feature"]: r["mean_abs"] for r in boosting.shapley_summary(boosting.shapley_values(model, df), FEATURES).collect()}
    assert summary["a"] == pytest.approx(np.mean([abs(r["phi_a"]) for r in got])) and summary["a"] > summary["c"]


def test_permutation_shows_what_matters(spark, df):
    noisy = df.withColumn("noise", (F.xxhash64("id") % 7).cast("double"))
    model = Booster(trees=6, depth=2, step=0.5).fit(noisy, [*FEATURES, "noise"])
    rise = {r["feature"]: r["rise"] for r in boosting.permutation_importance(model, noisy, "id").collect()}
    assert rise["a"] > 0.5 > 0.1 > abs(rise["noise"])
    # the same deal by hand: one box holds all rows
    x = np.array([[np.nan if r[f] is None else r[f] for f in model.features] for r in noisy.orderBy("id").collect()])
    y = np.array([r["y"] for r in noisy.orderBy("id").collect()])
    plain = np.sqrt(np.mean((y - model.predict(x)) ** 2))
    for k, name in enumerate(model.features):
        dealt = x.copy()
        dealt[:, k] = x[np.random.default_rng([7, k, 0]).permutation(len(x)), k]
        assert rise[name] == pytest.approx(np.sqrt(np.mean((y - model.predict(dealt)) ** 2)) - plain)


def test_folds_side_by_side_equal_one_by_one(df):
    rows = df.withColumns({"k": F.lit("x"), "ds": F.timestamp_seconds("id")})
    folded = ml.time_series_folds(rows, ["k"], ["ds", "id"], folds=3)
    booster = Booster(trees=2, depth=2, step=0.5)
    got = {r["fold"]: r for r in ml.fold_errors(folded, booster, FEATURES, "k").collect()}
    assert sorted(got) == [0, 1, 2]
    for fold in got:
        part = folded.where(F.col("fold") == fold)
        alone = booster.fit(part.where("role = 'train'"), FEATURES)
        test = boosting.score(alone, part.where("role = 'test'"))
        rmse, n = test.agg(F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)), F.count("*")).first()
        assert got[fold]["rmse"] == pytest.approx(rmse) and got[fold]["test_rows"] == n


def test_nothing_to_learn(spark, df):
    constant = Booster(trees=2, depth=2).fit(df.withColumn("y", F.lit(2.0)), FEATURES)
    assert all(not t.splits() for t in constant.trees) and boosting.score(constant, df).where("yhat <> 2").count() == 0
    none = Booster(trees=1, depth=1).fit(df.limit(0), FEATURES)
    assert boosting.score(none, df.limit(0)).count() == 0
