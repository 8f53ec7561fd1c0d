"""Splits, forecasts, boosted trees and model comparison."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pluvia.operators import boosting, ml
from pluvia.operators.boosting import Booster
from pluvia.operators.filters import trailing_from_latest
from pluvia.operators.trend import TrendModel
from pluvia.operators.windows import category_codes, row_lags, with_category_code
from pluvia.plans import common
from pluvia.plans.boosted_sql import boosted_ctes
from pluvia.plans.projections import SERIES
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.tables import sql
from pluvia.session import new_folder

POSITION = """SELECT reading_id, county, row_number() OVER (PARTITION BY county ORDER BY ds, reading_id) - 1 AS pos,
  count(*) OVER (PARTITION BY county) AS n FROM enriched"""
SPLIT_SQL = sql(
    """SELECT reading_id, CASE WHEN pos < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS role FROM placed""",
    "enriched",
    placed=POSITION,
)


@query("ml_chrono_split", SPLIT_SQL)
def chrono_split(t):
    return ml.chrono_split(t.enriched(), *SERIES).select("reading_id", "role")


@query("ml_chrono_split_split", SPLIT_SQL)
def chrono_split_split(t):
    """The same through the range-split path that large series take."""
    return ml.chrono_split(t.enriched(), *SERIES, rows_per_task=400).select("reading_id", "role")


@query(
    "ml_chrono_split_test_up",
    sql(
        "SELECT reading_id, CASE WHEN pos < n - ceil(CAST(0.2 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS role FROM placed",
        "enriched",
        placed=POSITION,
    ),
)
def chrono_split_test_up(t):
    return ml.chrono_split(t.enriched(), *SERIES, round_test_up=True).select("reading_id", "role")


@query(
    "ml_timeseries_folds",
    sql(
        f"""SELECT reading_id, {i("fold", "fold")}, CASE WHEN pos < n - (5 - fold) * (n // 6) THEN 'train' ELSE 'test' END AS role
        FROM placed, range(5) r(fold) WHERE pos < n - (5 - fold) * (n // 6) + n // 6""",
        "enriched",
        placed=POSITION,
    ),
)
def folds(t):
    return ml.time_series_folds(t.enriched(), *SERIES).select("reading_id", "fold", "role")


# A series shorter than two years supports the trend alone: the regression line and its prediction interval.
LINE = f"""SELECT county, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(x) AS mx, regr_sxx(y, x) AS sxx, CAST(count(*) AS DOUBLE) AS n,
  sqrt((regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / (count(*) - 2)) AS sigma, max(ds) AS last_ds
FROM timed GROUP BY county"""
YEARS = f"(floor(epoch(ds)) - {ml.ORIGIN}) / CAST({ml.YEAR_SECONDS} AS DOUBLE)"  # whole seconds, as the model counts
TIMED = f"SELECT *, {YEARS} AS x FROM enriched"
FUTURE = """SELECT line.*, date_trunc('month', last_ds) + to_months(CAST(k AS INTEGER)) AS ds FROM line, range(1, 13) r(k)"""


@query(
    "ml_seasonal_forecast",
    sql(
        f"""SELECT county, {ts("ds", "ds")}, {d("a + b * x", "yhat")}, {d("round(a + b * x - half, 3)", "yhat_lower")}, {d("round(a + b * x + half, 3)", "yhat_upper")}
        FROM (SELECT *, 1.96 * sigma * sqrt(1 + 1 / n + (x - mx) * (x - mx) / sxx) AS half FROM (SELECT *, {YEARS} AS x FROM future))""",
        "enriched",
        timed=TIMED,
        line=LINE,
        future=FUTURE,
    ),
)
def seasonal_forecast(t):
    """Twelve month starts ahead per county, with the interval; a short series supports the trend alone.

    The interval is shown at three decimals: times far from the origin cost its last digits.
    """
    model = ml.SeasonalModel(yearly=3)
    fitted = model.fit(t.enriched(), "county", "ds", "y")
    ends = [F.round(c, 3).alias(c) for c in ("yhat_lower", "yhat_upper")]
    return model.forecast(fitted, "county", 12).select("county", "ds", "yhat", *ends)


@query("ml_seasonal_forecast_daily")
def seasonal_forecast_daily(t):
    """The single-site form: daily terms, 56 six-hour steps. Tested against least squares."""
    model = ml.SeasonalModel(yearly=1, daily=3)
    fitted = model.fit(t.enriched(), "county", "ds", "y")
    return model.forecast(fitted, "county", 56, "6 hours").select("county", "ds", "yhat", "yhat_lower", "yhat_upper")


@query("ml_trend_forecast")
def trend_forecast(t):
    """The onset series of each county by a trend with changepoints and a yearly season: twelve months ahead."""
    model = TrendModel(yearly=3)
    fitted = model.fit(t.history(), "county", "observation_date", "cum_72hr_mm")
    return model.forecast(fitted, "county", 12).select("county", "ds", "trend", "yhat", "yhat_lower", "yhat_upper")


@query("ml_trend_changepoints")
def trend_changepoints(t):
    """When the rain of a county sets in or ends: changes of slope of its running total, hour by hour."""
    total = F.sum("precipitation").over(Window.partitionBy("county").orderBy("hour"))
    rows = common.hourly(t).select("county", "hour", total.alias("total"))
    model = TrendModel(share=0.95, flexibility=0.5)
    return model.changes(model.fit(rows, "county", "hour", "total"), "county", least=1.0)


@query(
    "ml_trend_history",
    sql(
        f"""SELECT e.county, {i("count(*)", "rows")}, {d("avg(abs(y - (a + b * x)))", "mae")}, {d("sqrt(avg((y - (a + b * x)) * (y - (a + b * x))))", "rmse")}
        FROM exact e JOIN line USING (county) GROUP BY e.county""",
        "enriched",
        exact="SELECT *, epoch(ds) AS x FROM enriched",
        line="SELECT county, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM exact GROUP BY county",
    ),
)
def trend_history(t):
    """Errors over the history of a trend that is too stiff to bend, which is the regression line."""
    stiff = TrendModel(flexibility=1e-9)
    rows = stiff.predict(t.enriched(), stiff.fit(t.enriched(), "county", "ds", "y"), "county", "ds")
    error = F.col("y") - F.col("yhat")
    return rows.groupBy("county").agg(F.count(F.lit(1)).alias("rows"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error**2)).alias("rmse"))


@query(
    "ml_seasonal_history",
    sql(
        f"""SELECT e.county, {i("count(*)", "rows")}, {i("12", "ahead")}, {d("avg(abs(y - (a + b * x)))", "mae")}, {d("round(max(b), 2)", "slope")}
        FROM timed e JOIN line USING (county) GROUP BY e.county""",
        "enriched",
        timed=TIMED,
        line=LINE,
    ),
)
def seasonal_history(t):
    """Fitted values for the whole history and twelve month starts: the mean error, and the trend
    alone, which is the regression line."""
    model = ml.SeasonalModel(yearly=0)
    rows = model.with_history(t.enriched(), "county", "ds", "y", 12)
    slope = model.fit(t.enriched(), "county", "ds", "y").select("county", F.round(F.col("coef")[1], 2).alias("slope"))
    past = F.col("y").isNotNull()
    return rows.groupBy("county").agg(
        F.count_if(past).alias("rows"), F.count_if(~past).alias("ahead"), F.avg(F.abs("residual")).alias("mae")
    ).join(slope, "county")


FEATURES = list(ml.LAG_FEATURES)
BOOSTER = Booster(trees=10, depth=3, step=0.3)
FOLD_BOOSTER = Booster(trees=4, depth=2, step=0.3)
FOLDS = 5


def training_rows(t):
    codes = category_codes(t.enriched(), "county")
    lagged = row_lags(t.enriched(), *SERIES, "y").dropna()
    return with_category_code(lagged, codes, "county", "county_cat")


TRAINING = """SELECT * FROM (SELECT reading_id AS id, county, ds, y, surface_pressure AS x0, lag(y, 1) OVER o AS x1, lag(y, 4) OVER o AS x2,
  code AS x3 FROM enriched JOIN (SELECT county, row_number() OVER (ORDER BY county) - 1 AS code FROM (SELECT DISTINCT county FROM enriched)) USING (county)
  WINDOW o AS (PARTITION BY county ORDER BY ds, reading_id)) WHERE x2 IS NOT NULL"""
TRAINING_PLACED = """SELECT *, row_number() OVER (PARTITION BY county ORDER BY ds, id) - 1 AS pos, count(*) OVER (PARTITION BY county) AS n FROM training"""
CHRONO = "SELECT *, CASE WHEN pos < floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS role FROM placed"
WHOLE = "SELECT *, 'train' AS role FROM training"
RECENT = """SELECT *, CASE WHEN ds < (SELECT max(ds) FROM training) - INTERVAL 14 DAY THEN 'train' ELSE 'test' END AS role FROM training"""


def _boosted(base: str, booster: Booster = BOOSTER) -> dict[str, str]:
    return boosted_ctes("model", base, booster, len(FEATURES))


def _chrono(t):
    """Rows with their role, and the model of the earlier ones."""
    parts = ml.chrono_split(training_rows(t), *SERIES)
    return parts, BOOSTER.fit(parts.filter("role = 'train'"), FEATURES)


def _squared(prediction: str):
    return (F.col("y") - F.col(prediction)) ** 2


@query(
    "ml_gbt_root",
    sql(
        f"""SELECT list_extract({FEATURES}, CAST(feature + 1 AS INTEGER)) AS feature, {d("cut", "cut")}, {d("gain", "gain")}
        FROM model_cuts WHERE tree = 0 AND node = 0""",
        "enriched",
        training=TRAINING,
        placed=TRAINING_PLACED,
        parts=CHRONO,
        **_boosted("parts", Booster(trees=1, depth=1, step=0.3)),
    ),
)
def gbt_root(t):
    """The first cut of the first tree: the feature, where it is cut, and what that gains."""
    _, model = _chrono(t)
    tree = model.trees[0]
    row = (model.features[tree.feature[0]], tree.cut[0], tree.gain[0])
    return t.spark.createDataFrame([row], "feature string, cut double, gain double")


@query(
    "ml_gbt_regression",
    sql(
        f"""SELECT county, {i("count(*) FILTER (role = 'train')", "train_rows")}, {i("count(*) FILTER (role = 'test')", "test_rows")},
        {d("sqrt(avg((y - p) * (y - p)) FILTER (role = 'test'))", "rmse")}, {d("sqrt(avg((y - m) * (y - m)) FILTER (role = 'test'))", "mean_rmse")}
        FROM model JOIN means USING (county) GROUP BY county""",
        "enriched",
        training=TRAINING,
        placed=TRAINING_PLACED,
        parts=CHRONO,
        means="SELECT county, avg(y) AS m FROM parts WHERE role = 'train' GROUP BY county",
        **_boosted("parts"),
    ),
)
def gbt_regression(t):
    """Per county: the split, the error on all later rows, and that of the mean of the earlier ones."""
    parts, model = _chrono(t)
    means = parts.filter("role = 'train'").groupBy("county").agg(F.avg("y").alias("mean"))
    scored = boosting.score(model, parts).join(means, "county")
    test = F.col("role") == "test"
    return scored.groupBy("county").agg(
        F.count_if(~test).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.sqrt(F.avg(F.when(test, _squared("yhat")))).alias("rmse"),
        F.sqrt(F.avg(F.when(test, _squared("mean")))).alias("mean_rmse"),
    )


@query(
    "ml_fold_errors",
    sql(
        " UNION ALL ".join(
            f"""SELECT {i(str(fold), "fold")}, county, {i("count(*) FILTER (role = 'train')", "train_rows")}, {i("count(*) FILTER (role = 'test')", "test_rows")},
            {d("sqrt(avg((y - p) * (y - p)) FILTER (role = 'test'))", "rmse")} FROM fold{fold} GROUP BY county"""
            for fold in range(FOLDS)
        ),
        "enriched",
        training=TRAINING,
        placed=TRAINING_PLACED,
        **{
            name: body
            for fold in range(FOLDS)
            for name, body in (
                {
                    f"parts{fold}": f"""SELECT *, CASE WHEN pos < n - ({FOLDS} - {fold}) * (n // 6) THEN 'train' ELSE 'test' END AS role FROM placed
                    WHERE pos < n - ({FOLDS} - {fold}) * (n // 6) + n // 6"""
                }
                | boosted_ctes(f"fold{fold}", f"parts{fold}", FOLD_BOOSTER, len(FEATURES))
            ).items()
        },
    ),
)
def fold_errors(t):
    """Per fold and county: rows to learn from, rows to test on, and the error; folds are fit side by side."""
    return ml.fold_errors(ml.time_series_folds(training_rows(t), *SERIES), FOLD_BOOSTER, FEATURES, "county")


@query(
    "ml_feature_importance",
    sql(
        f"""SELECT f.feature, {i("count(gain)", "splits")}, {d("coalesce(sum(gain), 0)", "gain")},
        {d("coalesce(sum(gain), 0) / (SELECT sum(gain) FROM model_cuts)", "share")}
        FROM (SELECT unnest({FEATURES}) AS feature, unnest(range({len(FEATURES)})) AS k) f LEFT JOIN model_cuts c ON c.feature = f.k GROUP BY f.feature""",
        "enriched",
        training=TRAINING,
        whole=WHOLE,
        **_boosted("whole"),
    ),
)
def importance(t):
    """Every input of the model: how often it is cut, and what its cuts gain."""
    return boosting.gain_importance(t.spark, BOOSTER.fit(training_rows(t), FEATURES))


@query("ml_shapley_values")
def shapley_values(t):
    """Shapley values of every row and feature. Tested against all subsets of features."""
    rows = training_rows(t)
    values = boosting.shapley_values(BOOSTER.fit(rows, FEATURES), rows)
    return values.select("reading_id", "county", "yhat", "expected", *[f"phi_{f}" for f in FEATURES])


@query(
    "ml_shapley_sums",
    sql(
        f"""SELECT id AS reading_id, {d("(SELECT avg(p) FROM model)", "expected")}, {d("p - (SELECT avg(p) FROM model)", "explained")} FROM model""",
        "enriched",
        training=TRAINING,
        whole=WHOLE,
        **_boosted("whole"),
    ),
)
def shapley_sums(t):
    """The expected prediction, and the sum of a row's Shapley values, which is what its prediction differs by."""
    rows = training_rows(t)
    values = boosting.shapley_values(BOOSTER.fit(rows, FEATURES), rows)
    total = sum((F.col(f"phi_{f}") for f in FEATURES), F.lit(0.0))
    return values.select("reading_id", "expected", total.alias("explained"))


@query("ml_shapley_summary")
def shapley_summary(t):
    """Mean size of the Shapley values of each feature."""
    rows = training_rows(t)
    return boosting.shapley_summary(boosting.shapley_values(BOOSTER.fit(rows, FEATURES), rows), FEATURES)


@query("ml_permutation_importance")
def permutation_importance(t):
    """Rise of the error when a feature's values are dealt to other rows. Tested against a slow version."""
    rows = training_rows(t)
    return boosting.permutation_importance(BOOSTER.fit(rows, FEATURES), rows, "reading_id")


@query(
    "ml_batch_score",
    sql(
        f"""SELECT id AS reading_id, county, {d("y", "y")}, {d("p", "yhat")} FROM model""",
        "enriched",
        training=TRAINING,
        whole=WHOLE,
        **_boosted("whole"),
    ),
)
def batch_score(t):
    """Fit, store, load and score the whole table."""
    rows, path = training_rows(t), new_folder(t.spark, "model")
    boosting.save(BOOSTER.fit(rows, FEATURES), t.spark, path)
    return boosting.score(boosting.load(t.spark, path), rows).select("reading_id", "county", "y", "yhat")


@query(
    "ml_model_store",
    sql(
        f"""SELECT {i("0", "differing")}, {i("count(*)", "rows")}, {d("avg(p)", "mean_yhat")} FROM model""",
        "enriched",
        training=TRAINING,
        whole=WHOLE,
        **_boosted("whole"),
    ),
)
def model_store(t):
    """A stored and reloaded model gives the same predictions on every row."""
    rows, path = training_rows(t), new_folder(t.spark, "model")
    model = BOOSTER.fit(rows, FEATURES)
    boosting.save(model, t.spark, path)
    both = boosting.score(boosting.load(t.spark, path), boosting.score(model, rows, "before"))
    return both.agg(
        F.count_if(F.col("before") != F.col("yhat")).alias("differing"), F.count(F.lit(1)).alias("rows"), F.avg("yhat").alias("mean_yhat")
    )


@query(
    "ml_model_compare",
    sql(
        f"""SELECT m.id AS reading_id, m.county, {ts("m.ds", "ds")}, {d("m.y", "y")}, {d("m.p", "boosted")},
        {d("l.a + l.b * " + YEARS.replace("(ds)", "(m.ds)"), "seasonal")}
        FROM model m JOIN line l USING (county) WHERE m.role = 'test'""",
        "enriched",
        training=TRAINING,
        parts=RECENT,
        timed=TIMED + " WHERE ds < (SELECT max(ds) FROM training) - INTERVAL 14 DAY",
        line=LINE,
        **_boosted("parts"),
    ),
)
def model_compare(t):
    """Actual value and both predictions at each time of the last 14 days; both models end before them."""
    rows = training_rows(t)
    recent = trailing_from_latest(rows, "ds", 14)
    cut = rows.agg(F.max("ds")).scalar() - F.make_dt_interval(F.lit(14))
    seasonal = ml.SeasonalModel(yearly=3)
    fitted = seasonal.fit(t.enriched().filter(F.col("ds") < cut), "county", "ds", "y")
    boosted = boosting.score(BOOSTER.fit(rows.filter(F.col("ds") < cut), FEATURES), recent, "boosted")
    aligned = seasonal.predict(boosted, fitted, "county", "ds")
    return aligned.select("reading_id", "county", "ds", "y", "boosted", F.col("yhat").alias("seasonal"))
