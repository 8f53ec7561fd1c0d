"""Second-order histogram boosting and what explains its trees: gain, Shapley values, permutation.

A level of a tree is one aggregate: sums of gradient and hessian by (node, feature, bin), combined map-side, of which
at most nodes x features x bins rows reach the driver. Trees are flat arrays in heap order (the children of node i are
2i + 1 and 2i + 2); a model has few of them and travels to tasks in a closure.

A row goes left if its value is below the cut. Nulls and NaNs go the way that gained more in training, left if
no null was seen. Equal gains, compared at six decimals, go to the first feature, then to the smallest cut.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.session import new_folder

STORE_EVERY = 10  # trees between written tables, which cut the lineage
GAIN_DECIMALS = 6


@dataclass
class Tree:
    """Nodes in heap order; ``feature`` is -1 at a leaf, -2 where there is no node."""

    feature: list[int]
    cut: list[float]
    nulls_left: list[bool]
    gain: list[float]
    value: list[float]
    cover: list[float]

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls([-2] * size, [0.0] * size, [True] * size, [0.0] * size, [0.0] * size, [0.0] * size)

    def splits(self) -> list[int]:
        return [n for n, f in enumerate(self.feature) if f >= 0]

    def leaves(self) -> list[int]:
        return [n for n, f in enumerate(self.feature) if f == -1]


@dataclass
class Boosted:
    """A fitted model: prediction = base + the value of one leaf of every tree."""

    features: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def places(self, x: np.ndarray, tree: Tree) -> np.ndarray:
        """The leaf of each row."""
        feature, cut, left = np.array(tree.feature), np.array(tree.cut), np.array(tree.nulls_left)
        node = np.zeros(len(x), np.int64)
        for _ in range(int(math.log2(len(feature) + 1)) - 1):
            split = feature[node] >= 0
            seen = x[np.arange(len(x)), np.maximum(feature[node], 0)]
            goes_left = np.where(np.isnan(seen), left[node], seen < cut[node])
            node = np.where(split, 2 * node + np.where(goes_left, 1, 2), node)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[self.places(x, tree)]
        return out

    @property
    def expected(self) -> float:
        """The mean prediction over the training rows."""
        means = (np.dot([t.value[n] for n in t.leaves()], [t.cover[n] for n in t.leaves()]) / t.cover[0] for t in self.trees)
        return self.base + float(sum(means))

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """Path-dependent Shapley values, one column a feature; a row adds up to prediction - ``expected``.

        On the path to a leaf a feature is met with the share z of training rows that its splits let through and, for a
        row, with o = 1 if the row passes them all. Over the other features of the path the product of (z + o x) has
        the sums over their subsets of a given size as coefficients, which Shapley's weights combine.
        """
        out = np.zeros((len(x), len(self.features)))
        for tree in self.trees:
            for leaf in tree.leaves():
                share, passes = self._path(x, tree, leaf)
                names = list(share)
                m = len(names)
                weights = [math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)]
                for name in names:
                    sums = np.zeros((m, len(x)))
                    sums[0] = 1.0
                    for other in names:
                        if other != name:
                            sums[1:] = sums[1:] * share[other] + sums[:-1] * passes[other]
                            sums[0] = sums[0] * share[other]
                    out[:, name] += tree.value[leaf] * (passes[name] - share[name]) * (np.array(weights) @ sums)
        return out

    def _path(self, x: np.ndarray, tree: Tree, leaf: int) -> tuple[dict[int, float], dict[int, np.ndarray]]:
        share, passes, node = {}, {}, leaf
        while node:
            up = (node - 1) // 2
            f = tree.feature[up]
            missing = np.isnan(x[:, f])
            left = np.where(missing, tree.nulls_left[up], x[:, f] < tree.cut[up])
            taken = left if node == 2 * up + 1 else ~left
            share[f] = share.get(f, 1.0) * tree.cover[node] / tree.cover[up]
            passes[f] = passes.get(f, 1.0) * taken.astype(float)
            node = up
        return share, passes

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "base": self.base, "trees": [vars(t) for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Boosted:
        held = json.loads(text)
        return cls(held["features"], held["base"], [Tree(**t) for t in held["trees"]])


@dataclass(frozen=True)
class Booster:
    """Squared-error boosting with ridge ``ridge`` on leaf values and at least ``least`` rows in a child."""

    trees: int = 100
    depth: int = 6
    step: float = 0.05
    ridge: float = 1.0
    least: float = 1.0
    bins: int = 256
    accuracy: int = 10_000

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "y") -> Boosted:
        """Rows without a label are left out."""
        rows = df.where(F.col(label).isNotNull()).select(
            F.col(label).cast("double").alias("_y"), *[F.col(f"`{c}`").cast("double").alias(f"_x{k}") for k, c in enumerate(features)]
        )
        names = [f"_x{k}" for k in range(len(features))]
        edges, base = self._edges(rows, names)
        model = Boosted(list(features), base)
        binned = rows
        for k, name in enumerate(names):
            inner = edges[k] or [0.0]
            buckets = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol=name, outputCol=f"_b{k}", handleInvalid="keep")
            binned = buckets.transform(binned)
        # the extra bucket of the library holds what is missing; here it is -1
        code = [
            F.when(F.col(n).isNull() | F.isnan(n), -1).otherwise(F.col(f"_b{k}").cast("int")).alias(f"_b{k}") for k, n in enumerate(names)
        ]
        state = binned.select("_y", F.lit(base).alias("_p"), *code).persist()
        held = [state]
        for number in range(self.trees):
            tree = self._grow(state, edges)
            model.trees.append(tree)
            moved = F.col("_p") + self._walk(tree, edges, lambda n: F.lit(tree.value[n]))
            state = state.withColumn("_p", moved)
            if number % STORE_EVERY == STORE_EVERY - 1 and number + 1 < self.trees:
                path = new_folder(df.sparkSession, "boosting")
                state.write.parquet(path)
                state = df.sparkSession.read.parquet(path)
                for old in held:
                    old.unpersist()
                held = []
            state = state.persist()
            held.append(state)
        for old in held:
            old.unpersist()
        return model

    def _edges(self, rows: DataFrame, names: list[str]) -> tuple[list[list[float]], float]:
        shares = [k / self.bins for k in range(1, self.bins)] + [1.0]
        known = {n: F.when(~F.isnan(n), F.col(n)) for n in names}
        made = rows.agg(
            F.avg("_y").alias("base"),
            *[F.percentile_approx(known[n], shares, self.accuracy).alias(n) for n in names],
        ).first()
        return [sorted(set(made[n] or [])) for n in names], float(made["base"] or 0.0)

    def _walk(self, tree: Tree, edges: list[list[float]], of_leaf, node: int = 0) -> Column:
        """What ``of_leaf`` gives for the node that a row reaches, as one expression on bins."""
        f = tree.feature[node]
        if f < 0:
            return of_leaf(node)
        left = F.col(f"_b{f}") <= edges[f].index(tree.cut[node])
        left = left if tree.nulls_left[node] else left & (F.col(f"_b{f}") >= 0)
        go = [self._walk(tree, edges, of_leaf, 2 * node + side) for side in (1, 2)]
        return F.when(left, go[0]).otherwise(go[1])

    def _grow(self, state: DataFrame, edges: list[list[float]]) -> Tree:
        tree = Tree.empty(self.depth)
        tree.feature[0] = -1
        fresh = [0]
        for level in range(self.depth + 1):
            at = state.select(
                self._walk(tree, edges, F.lit).alias("node"), (F.col("_p") - F.col("_y")).alias("g"), *[f"_b{k}" for k in range(len(edges))]
            )
            pairs = [F.struct(F.lit(k).alias("feature"), F.col(f"_b{k}").alias("bin")) for k in range(len(edges))]
            sums = (
                at.where(F.col("node").isin(fresh))
                .select("node", "g", F.inline(F.array(*pairs)))
                .groupBy("node", "feature", "bin")
                .agg(F.sum("g").alias("g"), F.count(F.lit(1)).cast("double").alias("h"))
                .toPandas()
            )
            fresh = self._split(tree, sums, edges, last=level == self.depth)
            if not fresh:
                return tree
        return tree

    def _split(self, tree: Tree, sums: pd.DataFrame, edges: list[list[float]], last: bool) -> list[int]:
        made = []
        for node, held in sums.groupby("node"):
            first = held[held["feature"] == 0]
            g, h = float(first["g"].sum()), float(first["h"].sum())
            tree.cover[node], tree.value[node] = h, -self.step * g / (h + self.ridge)
            for feature, part in () if last else held.groupby("feature"):
                found = self._best_cut(part, edges[feature], g, h)
                if found and found[0] > tree.gain[node]:
                    tree.feature[node] = int(feature)
                    tree.gain[node], tree.cut[node], tree.nulls_left[node] = found
            if tree.feature[node] >= 0:
                for child in (2 * node + 1, 2 * node + 2):
                    tree.feature[child] = -1
                    made.append(child)
        return made

    def _best_cut(self, part: pd.DataFrame, edges: list[float], g: float, h: float) -> tuple[float, float, bool] | None:
        """(gain, cut, whether nulls go left) of the best cut of one feature."""
        if not edges:
            return None
        by_bin = np.zeros((2, len(edges) + 1))
        seen = part[part["bin"] >= 0]
        by_bin[:, seen["bin"].to_numpy()] = seen[["g", "h"]].to_numpy().T
        missing = part[part["bin"] < 0][["g", "h"]].sum().to_numpy()
        below = np.cumsum(by_bin, axis=1)[:, :-1]
        best = None
        for left in (True, False) if missing[1] else (True,):
            gl, hl = below + (missing[:, None] if left else 0.0)
            gr, hr = g - gl, h - hl
            gain = 0.5 * (gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - g**2 / (h + self.ridge))
            gain = np.where((hl >= self.least) & (hr >= self.least), np.round(gain, GAIN_DECIMALS), -1.0)
            at = int(np.argmax(gain))
            if gain[at] > 0 and (best is None or gain[at] > best[0]):
                best = (float(gain[at]), edges[at], left)
        return best


def _scored(df: DataFrame, model: Boosted, fields: list[T.StructField], make) -> DataFrame:
    """``df`` with the columns that ``make`` computes from its feature matrix, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[model.features].astype("float64").to_numpy().reshape(len(batch), len(model.features))
            yield batch.assign(**make(x))

    return df.mapInPandas(run, T.StructType([*df.schema.fields, *fields]))


def score(model: Boosted, df: DataFrame, name: str = "yhat") -> DataFrame:
    return _scored(df, model, [T.StructField(name, T.DoubleType())], lambda x: {name: model.predict(x)})


def shapley_values(model: Boosted, df: DataFrame) -> DataFrame:
    """``df`` with yhat, the expected prediction and ``phi_<feature>``; the values add up to yhat - expected."""
    names = [f"phi_{f}" for f in model.features]

    def make(x: np.ndarray) -> dict:
        return {"yhat": model.predict(x), "expected": model.expected} | dict(zip(names, model.shapley(x).T))

    return _scored(df, model, [T.StructField(n, T.DoubleType()) for n in ("yhat", "expected", *names)], make)


def shapley_summary(values: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean_abs) of rows with Shapley values."""
    held = values.agg(*[F.avg(F.abs(F.col(f"phi_{f}"))).alias(f) for f in features])
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").alias("mean_abs")) for f in features]
    return held.select(F.inline(F.array(*pairs)))


def gain_importance(spark: SparkSession, model: Boosted) -> DataFrame:
    """(feature, splits, gain, share) over all trees; features that are never used have zeros."""
    rows = []
    for k, name in enumerate(model.features):
        gains = [t.gain[n] for t in model.trees for n in t.splits() if t.feature[n] == k]
        rows.append((name, len(gains), float(sum(gains))))
    whole = sum(r[2] for r in rows) or 1.0
    return spark.createDataFrame([(*r, r[2] / whole) for r in rows], "feature string, splits bigint, gain double, share double")


def permutation_importance(model: Boosted, df: DataFrame, row_id: str, label: str = "y", seed: int = 7) -> DataFrame:
    """(feature, rmse, rise): the error with the feature's values dealt to other rows, and its rise.

    Each feature has its own permutation: rows are grouped by a hash of their id into boxes of some
    thousands, and within a box the values in the order of one hash go to the rows in the order of another. Boxes are
    as even as the hash and no order over the whole table is made. All features are scored in one pass.
    """
    boxes = max(df.count() // 4096, 1)
    parts = []
    for k, name in enumerate(model.features):
        spread = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed), F.lit(k)), F.lit(boxes))
        parts.append(F.struct(F.lit(k).alias("feature"), spread.alias("box"), F.col(f"`{name}`").cast("double").alias("value")))
    inputs = F.array(*[F.col(f"`{f}`").cast("double") for f in model.features])
    rows = df.where(F.col(label).isNotNull()).select(F.col(row_id).alias("id"), F.col(label).cast("double").alias("y"), inputs.alias("x"), F.inline(F.array(*parts)))
    schema = "feature int, error double, rows bigint"

    def deal(table: pd.DataFrame) -> pd.DataFrame:
        k = int(table["feature"].iloc[0])
        table = table.sort_values("id")
        turn = np.random.default_rng([seed, k, int(table["box"].iloc[0])])
        x = np.array(table["x"].tolist(), float)
        x[:, k] = table["value"].to_numpy()[turn.permutation(len(table))]
        error = float(((table["y"].to_numpy() - model.predict(x)) ** 2).sum())
        return pd.DataFrame({"feature": [k], "error": [error], "rows": [len(table)]})

    dealt = rows.groupBy("feature", "box").applyInPandas(deal, schema)
    plain = score(model, df.where(F.col(label).isNotNull())).agg(F.sqrt(F.avg((F.col(label) - F.col("yhat")) ** 2))).scalar()
    names = F.array(*[F.lit(f) for f in model.features])
    total = dealt.groupBy("feature").agg(F.sqrt(F.sum("error") / F.sum("rows")).alias("rmse"))
    return total.select(F.element_at(names, F.col("feature") + 1).alias("feature"), "rmse", (F.col("rmse") - plain).alias("rise"))


def save(model: Boosted, spark: SparkSession, path: str) -> None:
    """One row: the model is a few arrays."""
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Boosted:
    return Boosted.from_json(spark.read.parquet(path).first()["model"])
