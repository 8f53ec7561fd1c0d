"""Series splits, the seasonal regression, boosted trees and their evaluation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.operators.joins import join_checked
from pluvia.operators.ordered import ROWS_PER_TASK, running
from pluvia.schemas import NEUTRAL_PRESSURE_HPA, NEUTRAL_TEMP_K

LAG_FEATURES = ("surface_pressure", "temp_lag_6h", "temp_lag_24h", "county_cat")
VECTOR = ("y", "surface_pressure", "temp_k", "temp_lag_6h", "temp_lag_24h", "county_cat")


def feature_vector(df: DataFrame) -> DataFrame:
    """The six scoring inputs with neutral values for what is missing."""
    neutral = {
        "y": 0.0,
        "surface_pressure": NEUTRAL_PRESSURE_HPA,
        "temp_k": NEUTRAL_TEMP_K,
        "temp_lag_6h": NEUTRAL_TEMP_K,
        "temp_lag_24h": NEUTRAL_TEMP_K,
        "county_cat": 0.0,
    }
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in neutral.items()}
    )


def _placed(df: DataFrame, keys: list[str], order: Sequence[str], rows_per_task: int) -> DataFrame:
    """Rows with their position ``_pos`` in the series and its length ``_n``."""
    return running(df, keys, order, name="_pos", total="_n", rows_per_task=rows_per_task)


def chrono_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    train: float = 0.8,
    round_test_up: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """First share of each series ``train``, the rest ``test``, in time order.

    The cut is ``int(train * n)``, or ``n - ceil((1 - train) * n)`` with ``round_test_up``.
    """
    keys = list(keys)
    n = F.col("_n")
    share = round(1 - train, 10)
    cut = n - F.ceil(F.lit(share) * n) if round_test_up else F.floor(F.lit(train) * n)
    role = F.when(F.col("_pos") < cut, "train").otherwise("test")
    return _placed(df, keys, order, rows_per_task).withColumn("role", role).drop("_pos", "_n")


def chrono_cutoff(df: DataFrame, keys: Sequence[str], time: str, train: float = 0.8) -> DataFrame:
    """The split without positions: an approximate cut-off time per series."""
    keys = list(keys)
    cuts = df.groupBy(*keys).agg(F.percentile_approx(time, train, 10_000).alias("_cut"))
    role = F.when(F.col(time) < F.col("_cut"), "train").otherwise("test")
    return join_checked(df, cuts, keys).withColumn("role", role).drop("_cut")


def time_series_folds(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: int = 5,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Expanding folds: fold i tests block i of ``n // (folds + 1)`` rows and trains before it."""
    n, pos = F.col("_n"), F.col("_pos")
    size = F.floor(n / (folds + 1))
    rows = _placed(df, list(keys), order, rows_per_task)
    each = rows.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(folds)])))
    start = n - (folds - F.col("fold")) * size
    role = F.when(pos < start, "train").when(pos < start + size, "test")
    return each.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_pos", "_n")


def fold_errors(folded: DataFrame, booster, features: Sequence[str], key: str, label: str = "y") -> DataFrame:
    """(fold, key, train_rows, test_rows, rmse) of rows dealt into folds.

    The models of all folds are fit side by side over one cached frame, each by a thread of the driver that
    only starts jobs; scoring is one plan over all folds.
    """
    from pluvia.operators import boosting

    held = folded.persist()
    try:
        numbers = sorted(r["fold"] for r in held.select("fold").distinct().collect())
        with ThreadPoolExecutor(max(len(numbers), 1)) as pool:
            models = list(pool.map(lambda n: booster.fit(held.where((F.col("fold") == n) & (F.col("role") == "train")), features, label), numbers))
        scored = [boosting.score(m, held.where(F.col("fold") == n)) for n, m in zip(numbers, models)]
        test = F.col("role") == "test"
        out = [
            s.groupBy("fold", key).agg(
                F.count_if(~test).alias("train_rows"),
                F.count_if(test).alias("test_rows"),
                F.sqrt(F.avg(F.when(test, (F.col(label) - F.col("yhat")) ** 2))).alias("rmse"),
            )
            for s in scored
        ]
        return reduce(DataFrame.unionByName, out)
    finally:
        held.unpersist()


YEAR_SECONDS = 31_557_600
DAY_SECONDS = 86_400
ORIGIN = 946_684_800  # 2000-01-01 UTC; keeps the trend term small


@dataclass(frozen=True)
class SeasonalModel:
    """Least squares on trend and Fourier terms, one fit per key.

    The normal equations are sums over rows, so Spark adds them up with partial
    aggregation and only one small matrix per key is solved. Intercept and trend are free;
    a seasonal coefficient has a normal prior of ``prior`` times the spread of the series.
    A season is used only if the series spans at least ``cycles`` of its periods: less
    cannot tell it from the trend. The interval counts the noise and the uncertainty of
    the coefficients, so it widens beyond the data.
    """

    yearly: int = 3
    daily: int = 0
    prior: float = 10.0
    cycles: float = 2.0
    interval: float = 1.96

    def terms(self, time: Column) -> list[Column]:
        seconds = F.unix_seconds(time).cast("double") - ORIGIN
        out = [F.lit(1.0), seconds / YEAR_SECONDS]
        for period, order in ((YEAR_SECONDS, self.yearly), (DAY_SECONDS, self.daily)):
            for k in range(1, order + 1):
                angle = seconds * (2 * math.pi * k / period)
                out += [F.sin(angle), F.cos(angle)]
        return out

    @property
    def size(self) -> int:
        return 2 + 2 * (self.yearly + self.daily)

    @property
    def penalty(self) -> float:
        """What a seasonal coefficient adds to the diagonal of the normal equations."""
        return 1 / self.prior**2 if math.isfinite(self.prior) else 0.0

    def fit(self, df: DataFrame, key: str, time: str, value: str) -> DataFrame:
        """(key, coef, sigma, spread, used, last_ds) per key.

        ``spread`` is the inverse of the penalised normal equations, row by row, and
        ``used`` tells which terms the span of the series supports.
        """
        rows = df.filter(F.col(value).isNotNull() & F.col(time).isNotNull())
        x = [f"_x{i}" for i in range(self.size)]
        named = rows.select(
            key, F.col(time).alias("_t"), F.col(value).alias("_y"),
            *[c.alias(n) for n, c in zip(x, self.terms(F.col(time)))],
        )
        pairs = [(a, b) for i, a in enumerate(x) for b in x[i:]]
        moments = named.groupBy(key).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("_y") * F.col("_y")).alias("yy"),
            F.array(*[F.sum(F.col(a) * F.col("_y")) for a in x]).alias("xy"),
            F.array(*[F.sum(F.col(a) * F.col(b)) for a, b in pairs]).alias("xx"),
            (F.unix_seconds(F.max("_t")) - F.unix_seconds(F.min("_t"))).alias("span"),
            F.max("_t").alias("last_ds"),
        )
        size, penalty = self.size, self.penalty
        needs = [0.0, 1.0]
        for period, order in ((YEAR_SECONDS, self.yearly), (DAY_SECONDS, self.daily)):
            needs += [self.cycles * period] * (2 * order)

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            upper = np.triu_indices(size)
            for batch in batches:
                made = {"coef": [], "sigma": [], "spread": [], "used": []}
                for n, yy, xy, xx, span in zip(batch["n"], batch["yy"], batch["xy"], batch["xx"], batch["span"]):
                    gram = np.zeros((size, size))
                    gram[upper] = xx
                    gram = gram + np.triu(gram, 1).T
                    used = np.array(needs) <= span
                    at = np.flatnonzero(used)
                    ridge = np.diag(np.where(at < 2, 0.0, penalty))
                    # the trend counts from its mean, far from the origin of time it is nearly constant
                    centre = np.eye(size)
                    centre[0, 1] = -gram[0, 1] / gram[0, 0]
                    near = centre.T @ gram @ centre
                    if near[1, 1] <= 1e-13 * gram[1, 1]:
                        near[1, :] = near[:, 1] = 0.0
                    inverse = np.zeros((size, size))
                    # as many rows as terms may still leave the equations without one solution
                    inverse[np.ix_(at, at)] = np.linalg.pinv(near[np.ix_(at, at)] + ridge, rcond=1e-14, hermitian=True)
                    coef = centre @ (inverse @ (centre.T @ np.asarray(xy)))
                    inverse = centre @ inverse @ centre.T
                    sse = yy - 2 * coef @ np.asarray(xy) + coef @ gram @ coef
                    made["coef"].append(coef.tolist())
                    made["sigma"].append(float(np.sqrt(max(sse, 0.0) / max(n - len(at), 1))))
                    made["spread"].append(inverse.ravel().tolist())
                    made["used"].append(used.tolist())
                yield pd.DataFrame({key: batch[key], **made, "last_ds": batch["last_ds"]})

        return moments.mapInPandas(
            solve,
            f"{key} string, coef array<double>, sigma double, spread array<double>, used array<boolean>, last_ds timestamp",
        )

    def predict(self, df: DataFrame, fitted: DataFrame, key: str, time: str) -> DataFrame:
        """Add yhat and its interval; evaluated in the JVM from the coefficients."""
        rows = join_checked(df, fitted.drop("last_ds", "used"), [key])
        terms, size = self.terms(F.col(time)), self.size
        x = [f"_x{i}" for i in range(size)]
        rows = rows.withColumns(dict(zip(x, terms)))
        yhat, unsure = F.lit(0.0), F.lit(0.0)
        for i in range(size):
            yhat = yhat + F.col("coef")[i] * F.col(x[i])
            for j in range(size):
                unsure = unsure + F.col("spread")[i * size + j] * F.col(x[i]) * F.col(x[j])
        half = self.interval * F.col("sigma") * F.sqrt(1 + F.greatest(unsure, F.lit(0.0)))
        rows = rows.withColumns({"yhat": yhat, "_half": half})
        return rows.withColumns(
            {"yhat_lower": F.col("yhat") - F.col("_half"), "yhat_upper": F.col("yhat") + F.col("_half")}
        ).drop("coef", "sigma", "spread", "_half", *x)

    def with_history(self, df: DataFrame, key: str, time: str, value: str, periods: int) -> DataFrame:
        """(key, time, value, yhat, its interval, residual): every past row, then ``periods`` month starts."""
        fitted = self.fit(df, key, time, value)
        past = self.predict(df.select(key, time, value), fitted, key, time)
        ahead = self.forecast(fitted, key, periods).withColumnRenamed("ds", time)
        rows = past.unionByName(ahead, allowMissingColumns=True)
        return rows.withColumn("residual", F.col(value) - F.col("yhat"))

    def forecast(self, fitted: DataFrame, key: str, periods: int, step: str = "1 month") -> DataFrame:
        """Predictions at the next month starts, or at fixed steps after the last row."""
        monthly = step == "1 month"
        base = F.date_trunc("month", "last_ds") if monthly else F.col("last_ds")
        unit = F.expr(f"interval {step}")
        frame = fitted.select(
            key, F.explode(F.sequence(base + unit, base + unit * periods, unit)).alias("ds")
        )
        return self.predict(frame, fitted, key, "ds")


def fit_boosted(
    df: DataFrame,
    features: Sequence[str] = LAG_FEATURES,
    label: str = "y",
    trees: int = 100,
    depth: int = 6,
    step: float = 0.05,
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees on the lag features (the target is not among them)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    booster = GBTRegressor(
        labelCol=label,
        featuresCol="features",
        predictionCol="yhat",
        maxIter=trees,
        maxDepth=depth,
        stepSize=step,
        seed=seed,
    )
    return Pipeline(stages=[assembler, booster]).fit(df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def feature_importance(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Importance of each input of a fitted model; one row per feature."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
