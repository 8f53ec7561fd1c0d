"""Piecewise-linear trend with sparse changepoints, fit per key from moments.

The trend is a line whose slope may change at fixed times, evenly spread over the first part of the series; the
changes have a Laplace prior, so most of them are zero. The seasons are Fourier terms with a normal prior. All that the fit
needs are sums of 1, t, y and the seasonal terms and of their products within each stretch between two possible
changes: a change of slope at s acts as max(t - s, 0), which is t - s on every later stretch and 0 before. Spark adds
them up by (key, stretch); coordinate descent then runs on one small matrix per key, and the noise variance
is renewed until it settles.

The interval counts the noise and slope changes to come, as frequent and as large as those found: with rate r and mean
size b their variance at distance h beyond the data is 2 r b^2 h^3 / 3.

Rows without time or value are left out. A key with one time only has a level and no trend.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.operators.joins import join_checked
from pluvia.operators.ml import DAY_SECONDS, YEAR_SECONDS

FITTED = "slope double, level double, deltas array<double>, season array<double>, sigma double, change double, start double, span double, last_ds timestamp"


@dataclass(frozen=True)
class TrendModel:
    """``changepoints`` possible changes in the first ``share`` of a series.

    ``flexibility`` is the scale of the Laplace prior of slope changes and ``prior`` that of the seasonal terms, both for
    values divided by their largest and times scaled to the length of the series. A season is used only if the series spans
    ``cycles`` of its periods.
    """

    changepoints: int = 25
    share: float = 0.8
    flexibility: float = 0.05
    yearly: int = 0
    daily: int = 0
    prior: float = 10.0
    cycles: float = 2.0
    interval: float = 1.96
    rounds: int = 20

    @property
    def places(self) -> list[float]:
        """Where the slope may change, in units of the length of the series."""
        return [self.share * (j + 1) / self.changepoints for j in range(self.changepoints)]

    def waves(self, time: Column) -> list[Column]:
        seconds, out = F.unix_micros(time) / 1e6, []
        for period, order in ((YEAR_SECONDS, self.yearly), (DAY_SECONDS, self.daily)):
            for k in range(1, order + 1):
                angle = seconds * (2 * math.pi * k / period)
                out += [F.sin(angle), F.cos(angle)]
        return out

    @property
    def needs(self) -> np.ndarray:
        """The span in seconds that each seasonal term asks for."""
        return np.array([self.cycles * YEAR_SECONDS] * (2 * self.yearly) + [self.cycles * DAY_SECONDS] * (2 * self.daily))

    def _stretch(self, t: Column) -> Column:
        """How many possible changes lie at or before a time."""
        step = self.share / self.changepoints if self.changepoints else 1.0
        return F.least(F.greatest(F.floor(t / step), F.lit(0)), F.lit(self.changepoints)).cast("int")

    def fit(self, df: DataFrame, key: str, time: str, value: str) -> DataFrame:
        """(key, slope, level, deltas, season, sigma, change, start, span, last_ds), one row a key."""
        rows = df.where(F.col(value).isNotNull() & F.col(time).isNotNull())
        rows = rows.select(key, F.col(time).cast("timestamp").alias("_ds"), (F.unix_micros(F.col(time).cast("timestamp")) / 1e6).alias("_s"), F.col(value).cast("double").alias("_y"))
        ends = rows.groupBy(key).agg(
            F.min("_s").alias("start"), (F.max("_s") - F.min("_s")).alias("span"), F.max(F.abs("_y")).alias("scale"), F.max("_ds").alias("last_ds")
        )
        scaled = join_checked(rows, ends, [key]).withColumn("_t", F.when(F.col("span") > 0, (F.col("_s") - F.col("start")) / F.col("span")).otherwise(0.0))
        scaled = scaled.withColumn("_y", F.col("_y") / F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0))
        waves = {f"_w{i}": w for i, w in enumerate(self.waves(F.col("_ds")))}
        terms = scaled.withColumns(waves) if waves else scaled
        names = ["_one", "_t", *waves, "_y"]
        terms = terms.withColumns({"_one": F.lit(1.0), "_j": self._stretch(F.col("_t"))})
        pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
        sums = terms.groupBy(key, "_j").agg(F.array(*[F.sum(F.col(a) * F.col(b)) for a, b in pairs]).alias("sums"))
        held = sums.groupBy(key).agg(F.collect_list(F.struct("_j", "sums")).alias("stretches"))
        model = self

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [model._solve(s, span, scale) for s, span, scale in zip(batch["stretches"], batch["span"], batch["scale"])]
                columns = ["slope", "level", "deltas", "season", "sigma", "change"]
                yield pd.DataFrame({key: batch[key]} | {c: [f[c] for f in found] for c in columns} | {c: batch[c] for c in ("start", "span", "last_ds")})

        joined = held.join(ends, key)
        return joined.mapInPandas(solve, f"{key} {dict(df.dtypes)[key]}, {FITTED}")

    def _moments(self, stretches, waves: int) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Gram matrix and moments with y of (1, t, changes, waves), the sum of y squares, and the rows."""
        size, places = 3 + waves, np.array(self.places)
        part = np.zeros((self.changepoints + 1, size, size))
        upper = np.triu_indices(size)
        for s in stretches:
            part[(s["_j"], *upper)] = s["sums"]
        part = part + np.triu(part, 1).transpose(0, 2, 1)
        # sums over all stretches from number j on
        tail = np.cumsum(part[::-1], axis=0)[::-1]
        base = [0, 1, *range(2, 2 + waves), 2 + waves]
        n = 2 + self.changepoints + waves
        gram, xy = np.zeros((n, n)), np.zeros(n)
        plain = [0, 1, *range(2 + self.changepoints, n)]
        whole = tail[0]
        gram[np.ix_(plain, plain)] = whole[np.ix_(base[:-1], base[:-1])]
        xy[plain] = whole[base[:-1], -1]
        for i in range(self.changepoints):
            late, at = tail[i + 1], 2 + i
            row = late[1] - places[i] * late[0]
            gram[at, plain] = gram[plain, at] = row[base[:-1]]
            xy[at] = row[-1]
            for j in range(i, self.changepoints):
                both = tail[j + 1]
                gram[at, 2 + j] = gram[2 + j, at] = both[1, 1] - (places[i] + places[j]) * both[0, 1] + places[i] * places[j] * both[0, 0]
        return gram, xy, whole[-1, -1], whole[0, 0]

    def _solve(self, stretches, span: float, scale: float) -> dict:
        waves = len(self.needs)
        gram, xy, yy, n = self._moments(stretches, waves)
        used = np.ones(len(xy), bool)
        used[2 + self.changepoints :] = self.needs <= span
        used[1 : 2 + self.changepoints] = span > 0
        used &= np.diag(gram) > 0
        ridge = np.zeros(len(xy))
        ridge[2 + self.changepoints :] = 1 / self.prior**2
        sparse = np.zeros(len(xy), bool)
        sparse[2 : 2 + self.changepoints] = True
        free = np.flatnonzero(used & ~sparse)
        coef = np.zeros(len(xy))
        coef[free] = np.linalg.pinv(gram[np.ix_(free, free)], hermitian=True) @ xy[free]

        def rest(c: np.ndarray) -> float:
            return max(yy - 2 * c @ xy + c @ gram @ c, 0.0)

        variance = max(rest(coef) / n, 1e-12)
        for _ in range(self.rounds):
            coef = descend(gram, xy, np.where(sparse, variance / self.flexibility, 0.0), ridge * variance, used, coef)
            renewed = max(rest(coef) / n, 1e-12)
            if abs(renewed - variance) <= 1e-6 * variance:
                break
            variance = renewed
        factor, deltas = scale or 1.0, coef[2 : 2 + self.changepoints]
        return {
            "slope": float(coef[1] * factor),
            "level": float(coef[0] * factor),
            "deltas": (deltas * factor).tolist(),
            "season": (coef[2 + self.changepoints :] * factor).tolist(),
            "sigma": float(np.sqrt(rest(coef) / max(n - np.count_nonzero(coef), 1)) * factor),
            "change": float(np.abs(deltas).mean() * factor) if len(deltas) else 0.0,
        }

    def predict(self, df: DataFrame, fitted: DataFrame, key: str, time: str) -> DataFrame:
        """``df`` with yhat, trend and the interval, as expressions on the coefficients."""
        rows = join_checked(df, fitted.drop("last_ds"), [key])
        seconds = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
        t = F.when(F.col("span") > 0, (seconds - F.col("start")) / F.col("span")).otherwise(0.0)
        rows = rows.withColumn("_t", t)
        trend = F.col("level") + F.col("slope") * F.col("_t")
        for j, place in enumerate(self.places):
            trend = trend + F.col("deltas")[j] * F.greatest(F.col("_t") - place, F.lit(0.0))
        season = F.lit(0.0)
        for i, wave in enumerate(self.waves(F.col(time).cast("timestamp"))):
            season = season + F.col("season")[i] * wave
        rows = rows.withColumns({"trend": trend, "_season": season})
        ahead = F.greatest(F.col("_t") - 1, F.lit(0.0))
        rate = self.changepoints / self.share
        changes = F.col("change") ** 2 * ahead**3 * (2 * rate / 3)
        half = self.interval * F.sqrt(F.col("sigma") ** 2 + changes)
        rows = rows.withColumns({"yhat": F.col("trend") + F.col("_season"), "_half": half})
        rows = rows.withColumns({"yhat_lower": F.col("yhat") - F.col("_half"), "yhat_upper": F.col("yhat") + F.col("_half")})
        return rows.drop("slope", "level", "deltas", "season", "sigma", "change", "start", "span", "_t", "_season", "_half")

    def forecast(self, fitted: DataFrame, key: str, periods: int, step: str = "1 month") -> DataFrame:
        """The next ``periods`` month starts, or fixed steps after the last row."""
        base = F.date_trunc("month", "last_ds") if step == "1 month" else F.col("last_ds")
        unit = F.expr(f"interval {step}")
        frame = fitted.select(key, F.explode(F.sequence(base + unit, base + unit * periods, unit)).alias("ds"))
        return self.predict(frame, fitted, key, "ds")

    def changes(self, fitted: DataFrame, key: str, least: float = 1e-6) -> DataFrame:
        """(key, ds, delta): the changes of slope, per length of the series, that the fit kept."""
        each = fitted.select(key, "start", "span", F.posexplode("deltas").alias("j", "delta"))
        place = F.element_at(F.array(*[F.lit(p) for p in self.places]), F.col("j") + 1)
        kept = each.where(F.abs("delta") > least).withColumn("ds", F.timestamp_seconds(F.col("start") + F.col("span") * place))
        return kept.select(key, "ds", "delta")


def descend(
    gram: np.ndarray, xy: np.ndarray, lasso: np.ndarray, ridge: np.ndarray, used: np.ndarray, start: np.ndarray, rounds: int = 2_000
) -> np.ndarray:
    """The least of |y - X c|^2 / 2 + lasso |c| + ridge c^2 / 2 by coordinate descent on the moments.

    Unpenalised terms are solved together, given the others, in each round: line and changes are nearly collinear.
    """
    coef = np.where(used, start, 0.0)
    free = np.flatnonzero(used & (lasso == 0))
    inverse = np.linalg.pinv(gram[np.ix_(free, free)] + np.diag(ridge[free]), hermitian=True)
    # changes with the free terms projected out
    steep = np.flatnonzero(used & (lasso > 0))
    cross = gram[np.ix_(steep, free)]
    inner = gram[np.ix_(steep, steep)] - cross @ inverse @ cross.T
    target = xy[steep] - cross @ inverse @ xy[free]
    c, size = coef[steep].copy(), np.diag(inner).copy()
    pull = inner @ c
    limit = lasso[steep]
    for number in range(rounds):
        moved = 0.0
        for i in range(len(steep)):
            if size[i] <= 1e-12:
                continue
            left = target[i] - pull[i] + size[i] * c[i]
            new = math.copysign(max(abs(left) - limit[i], 0.0), left) / size[i]
            if new != c[i]:
                pull += inner[:, i] * (new - c[i])
                moved = max(moved, abs(new - c[i]))
                c[i] = new
        if moved < 1e-12:
            break
        if number % 10 == 9:
            # with the signs known the rest is linear; taken if it keeps them and no other change would enter
            kept = np.flatnonzero(c)
            exact = np.linalg.lstsq(inner[np.ix_(kept, kept)], target[kept] - limit[kept] * np.sign(c[kept]), rcond=None)[0]
            slack = np.abs(target - inner[:, kept] @ exact) - limit
            slack[kept] = 0.0
            if np.all(np.sign(exact) == np.sign(c[kept])) and np.all(slack <= 1e-9 * (1 + limit)):
                c[kept] = exact
                break
    coef[steep] = c
    coef[free] = inverse @ (xy[free] - cross.T @ c)
    return coef
