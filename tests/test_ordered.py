"""Ordered operators against brute force, on the plain and on the range-split path."""

import math
import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvia.operators import ordered
from pluvia.operators.ml import chrono_split
from pluvia.operators.onset import onset_by_rows
from pluvia.operators.ordered import BLOCK, fill_next, over_rows, quantiles, running
from pluvia.operators.windows import row_lags

PLAIN, SPLIT = 10**9, 7


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t int, id int, v double")


def skewed(n=120, seed=1):
    """One key and one instant hold most rows; a null key and null values occur."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        out.append((key, rng.choice([5, 5, 5, 1, 2, 9]), i, rng.choice([None, 0.0, float(i % 11)])))
    return out


def series(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


def result(df, column):
    return {r["id"]: r[column] for r in df.collect()}


@pytest.mark.parametrize("limit", [PLAIN, SPLIT])
@pytest.mark.parametrize("back", [1, 4, 30])
def test_lag_and_frame(spark, limit, back):
    data = skewed()

    def make(w):
        return [
            {"lagged": F.lag("v", back).over(w), "n": F.count(F.lit(1)).over(w.rowsBetween(-back, 0))}
        ]

    out = over_rows(frame(spark, data), ["k"], ["t", "id"], back, make, "pos", limit)
    got = {r["id"]: (r["lagged"], r["n"], r["pos"]) for r in out.collect()}
    want = {}
    for group in series(data).values():
        for p, row in enumerate(group):
            want[row[2]] = (group[p - back][3] if p >= back else None, min(p, back) + 1, p)
    assert got == want


@pytest.mark.parametrize("limit", [PLAIN, SPLIT])
def test_running_position_and_total(spark, limit):
    data = skewed(seed=2)
    out = running(frame(spark, data), ["k"], ["t", "id"], name="pos", total="n", rows_per_task=limit)
    want = {}
    for group in series(data).values():
        want.update({row[2]: (p, len(group)) for p, row in enumerate(group)})
    assert {r["id"]: (r["pos"], r["n"]) for r in out.collect()} == want


@pytest.mark.parametrize("limit", [PLAIN, SPLIT])
def test_fill_next(spark, limit):
    data = [(k, t, i, v if i % 9 == 0 else None) for k, t, i, v in skewed(seed=3)]
    got = result(fill_next(frame(spark, data), ["k"], ["t", "id"], ["v"], limit), "v")
    want = {}
    for group in series(data).values():
        upcoming = None
        for row in reversed(group):
            upcoming = row[3] if row[3] is not None else upcoming
            want[row[2]] = upcoming
    assert got == want


def exact(values, p):
    h = (len(values) - 1) * p
    lo, hi = values[math.floor(h)], values[math.ceil(h)]
    return lo + (hi - lo) * (h - math.floor(h))


@pytest.mark.parametrize("limit", [PLAIN, 3])
def test_quantiles(spark, limit):
    data = skewed(seed=4)
    ps = {"q0": 0.0, "q25": 0.25, "q95": 0.95, "q1": 1.0}
    got = {r["k"]: r for r in quantiles(frame(spark, data), ["k"], "v", ps, rows_per_task=limit).collect()}
    near = quantiles(frame(spark, data), ["k"], "v", {"p": 0.99}, True, limit)
    ranked = {r["k"]: r["p"] for r in near.collect()}
    for key, group in series(data).items():
        values = sorted(r[3] for r in group if r[3] is not None)
        for name, p in ps.items():
            assert got[key][name] == pytest.approx(exact(values, p))
        assert ranked[key] == values[min(int(0.99 * len(values)), len(values) - 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 3)), min_size=1, max_size=40),
    st.integers(1, 6),
    st.integers(1, 9),
)
def test_split_equals_plain(spark, spec, back, limit):
    data = [(k, t, i, float(i)) for i, (k, t) in enumerate(spec)]

    def make(w):
        return [{"s": F.sum("v").over(w.rowsBetween(-back, 0))}]

    plain = over_rows(frame(spark, data), ["k"], ["t", "id"], back, make, rows_per_task=PLAIN)
    split = over_rows(frame(spark, data), ["k"], ["t", "id"], back, make, rows_per_task=limit)
    assert result(plain, "s") == result(split, "s")


def test_busy_instant_is_split(spark):
    """A key whose rows all share one instant still spreads over blocks of bounded size."""
    data = [("hot", 5, i, 1.0) for i in range(400)] + [(f"k{i}", i, 1000 + i, 1.0) for i in range(200)]
    blocks = ordered.blocks_of(frame(spark, data), ["k"], ["t", "id"], 50)
    sizes = [r["count"] for r in blocks.groupBy("k", BLOCK).count().collect()]
    hot = blocks.filter("k = 'hot'").select(BLOCK).distinct().count()
    assert sum(sizes) == 600 and hot >= 6 and max(sizes) <= 120


def test_split_is_one_exchange_of_the_rows_and_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, skewed()).write.parquet(path)
    rows = spark.read.parquet(path)
    out = over_rows(rows, ["k"], ["t", "id"], 3, lambda w: [{"l": F.lag("v", 3).over(w)}], "pos", SPLIT)
    out.count()
    text = out._jdf.queryExecution().executedPlan().toString()
    main = text.split("Initial Plan")[-1]
    assert "hashpartitioning(k" in main and ", _block" in main and "rangepartitioning" not in main
    assert main.count(", _block") >= 1 and set(out.inputFiles()) == set(rows.inputFiles())


def test_small_keys_take_the_plain_window(spark):
    data = [(f"k{i}", i, i, 1.0) for i in range(50)]
    assert ordered.blocks_of(frame(spark, data), ["k"], ["t", "id"], 5) is None


def test_short_blocks_borrow_from_several(spark):
    """One row per block: a frame reaches across many blocks."""
    data = [("a", i, i, float(i)) for i in range(40)]

    def make(w):
        return [{"s": F.sum("v").over(w.rowsBetween(-9, 0)), "l": F.lag("v", 9).over(w)}]

    out = over_rows(frame(spark, data), ["k"], ["t", "id"], 9, make, "pos", 1)
    for r in out.collect():
        i = r["id"]
        want = (sum(range(max(0, i - 9), i + 1)), float(i - 9) if i >= 9 else None, i)
        assert (r["s"], r["l"], r["pos"]) == want


def test_quantile_count_and_mean(spark):
    data = [("a", 0, i, v) for i, v in enumerate([1.0, 1.0, 4.0, None])]
    row = quantiles(frame(spark, data), ["k"], "v", {"p": 0.5}, count="n", mean="m").first()
    assert (row["p"], row["n"], row["m"]) == (1.0, 3, 2.0)


def test_empty_input(spark):
    empty = frame(spark, [])
    assert running(empty, ["k"], ["t"], rows_per_task=1).count() == 0
    assert quantiles(empty, ["k"], "v", {"p": 0.5}).count() == 0


def test_what_a_row_meets_does_not_grow_with_the_cuts(spark):
    """A key of many thousand cuts: every node of their tree is small, and together they hold each cut once."""
    rows = spark.range(40_000).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("t"), F.col("id").cast("int"))
    tree = ordered._tree(rows, ["k"], ["t", "id"], 1, 40_000)
    sizes = [t.agg(F.max(F.size("_o_heads")), F.sum(F.size("_o_heads")), F.count("*")).first() for t in tree]
    assert len(tree) > 1 and max(s[0] for s in sizes) <= ordered.FANOUT
    assert sizes[-1][1] == 40_000 // ordered.CELLS and sizes[-1][2] >= 40_000 // ordered.CELLS // ordered.FANOUT


@pytest.mark.parametrize("span", [1, 8])
def test_many_blocks_of_one_key(spark, monkeypatch, span):
    """40,000 rows in blocks of two, in more pieces than one node of the tree has cuts."""
    monkeypatch.setattr(ordered, "SPAN", span)
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 100 == 0, None).otherwise("a").alias("k"),
        F.floor(F.col("id") / 7).cast("int").alias("t"),
        F.col("id").cast("int"),
        F.when(F.col("id") % 10 == 9, F.col("id").cast("double")).alias("v"),
    )
    keys, order = ["k"], ["t", "id"]
    started = time.monotonic()
    lagged = over_rows(rows, keys, order, 5, lambda w: [{"l": F.lag("id", 5).over(w)}], "pos", 2)
    got = lagged.toPandas().sort_values("id")
    weighed = running(rows, keys, order, weight="t", name="sum", total="all", rows_per_task=2).toPandas().sort_values("id")
    filled = fill_next(rows, keys, order, ["v"], 2).toPandas().sort_values("id")
    assert time.monotonic() - started < 120
    for null, group in got.groupby(got["k"].isna()):
        assert len(group) == (400 if null else 39_600) and list(group["pos"]) == list(range(len(group)))
        assert group["l"][5:].tolist() == group["id"][:-5].tolist() and group["l"][:5].isna().all()
    for _, group in weighed.groupby(weighed["k"].isna()):
        assert list(group["sum"]) == list(group["t"].cumsum() - group["t"]) and set(group["all"]) == {group["t"].sum()}
    for _, group in filled.groupby(filled["k"].isna()):
        known = group["id"].where(group["id"] % 10 == 9)
        assert group["v"].fillna(-1).tolist() == known.bfill().fillna(-1).tolist()


def test_rows_that_share_their_order(spark):
    """Repeated rows and rows of one instant, told apart by a hash of the row: none is lost or doubled."""
    data = [("a", i // 50, 0, float(i % 50 // 2)) for i in range(1000)]
    out = over_rows(frame(spark, data), ["k"], ["t", "id"], 3, lambda w: [{"l": F.lag("v", 3).over(w)}], "pos", SPLIT)
    got = out.toPandas()
    assert sorted(got["pos"]) == list(range(1000))
    assert sorted(zip(got["t"], got["v"])) == sorted((t, v) for _, t, _, v in data)


SERIES = (["county"], ["event_time", "reading_id"])
MANY_BLOCKS = {
    "fill_next": lambda rows, limit: fill_next(rows, *SERIES, ["humidity"], limit),
    "row_lags": lambda rows, limit: row_lags(rows, *SERIES, "humidity", rows_per_task=limit),
    "chrono_split": lambda rows, limit: chrono_split(rows, *SERIES, rows_per_task=limit),
    "onset_by_rows": lambda rows, limit: onset_by_rows(rows, 14.0, rows_per_task=limit),
}


@pytest.mark.parametrize("operator", MANY_BLOCKS)
def test_many_blocks_equal_the_plain_window(spark, operator):
    """30,000 rows of one county and some of none, in blocks of three, in a time that does not grow with rows times cuts."""
    number = F.col("id")
    rows = spark.range(30_000).select(
        F.when(number % 50 == 0, None).otherwise("Kitui").alias("county"),
        F.timestamp_seconds(F.floor(number / 7)).alias("event_time"),
        number.alias("reading_id"),
        F.when(F.floor(number / 500) % 3 == 0, 0.0).otherwise((1 + number % 29) * 0.02).alias("precipitation"),
        F.when(number % 40 == 39, number.cast("double")).alias("humidity"),
    )
    plain = sorted(map(tuple, MANY_BLOCKS[operator](rows, PLAIN).collect()), key=repr)
    started = time.monotonic()
    split = sorted(map(tuple, MANY_BLOCKS[operator](rows, 3).collect()), key=repr)
    assert time.monotonic() - started < 60
    assert plain and split == plain
