"""Count-Min invariants against exact counts, and merging."""

import hashlib
import random
import struct

import pytest
from pyspark.sql import functions as F

from pluvia.operators.sketch import Sketch
from pluvia.schemas import COUNTY_NAMES

COUNTS = dict(zip(COUNTY_NAMES, (500, 300, 250, 150, 100, 80, 60, 40, 25, 10)))


@pytest.fixture(scope="module")
def updates(spark):
    return spark.createDataFrame(list(COUNTS.items()), "key string, n bigint")


def estimates(sketch, cells, keys):
    return {r["key"]: r["estimate"] for r in sketch.query(cells, keys).collect()}


def test_known_counts(spark, updates):
    sketch = Sketch()
    cells = sketch.build(updates, "key", "n")
    assert sketch.total(cells).first()[0] == sum(COUNTS.values()) == 1515
    got = estimates(sketch, cells, updates)
    assert all(got[k] >= n for k, n in COUNTS.items())
    candidates = spark.createDataFrame([(n, p) for p, n in enumerate(COUNTY_NAMES)], "key string, pos int")
    top = [r["key"] for r in sketch.top_k(cells, candidates, 5).collect()]
    assert top == COUNTY_NAMES[:5]


@pytest.mark.parametrize("width", [1, 7, 100])
def test_never_undercounts(spark, width):
    rng = random.Random(width)
    data = [(f"k{rng.randint(0, 60)}", rng.randint(-1, 5)) for _ in range(400)]
    sketch = Sketch(width=width, depth=3)
    df = spark.createDataFrame(data, "key string, n bigint")
    exact = df.filter("n >= 1").groupBy("key").agg(F.sum("n").alias("true_count"))
    report = sketch.error_report(sketch.build(df, "key", "n"), exact).collect()
    assert all(r["overcount"] >= 0 and r["true_count"] + r["overcount"] == r["estimate"] for r in report)
    assert all(r["total"] == sum(n for _, n in data if n >= 1) for r in report)


def test_merge_equals_build_of_union(spark, updates):
    sketch = Sketch(width=13, depth=4, seed=7)
    more = spark.createDataFrame([("x", 3), ("Meru", 4)], "key string, n bigint")
    merged = sketch.merge(sketch.build(updates, "key", "n"), sketch.build(more, "key", "n"))
    whole = sketch.build(updates.unionByName(more), "key", "n")
    assert set(map(tuple, merged.collect())) == set(map(tuple, whole.collect()))


def test_cells_match_the_published_hash(spark):
    sketch = Sketch()
    row = spark.createDataFrame([("Nairobi",)], "key string").select(sketch.cells_of(F.col("key")).alias("c"))
    want = []
    for i, seed in enumerate(sketch.row_seeds):
        digest = hashlib.md5(struct.pack(">I", seed) + b"Nairobi").digest()
        want.append((i, int.from_bytes(digest[:8], "big") % 1000))
    assert [tuple(c) for c in row.first()["c"]] == want


def test_unseen_key_and_empty_sketch(spark, updates):
    sketch = Sketch()
    nobody = spark.createDataFrame([("nobody",)], "key string")
    assert estimates(sketch, sketch.build(updates, "key", "n"), nobody)["nobody"] >= 0
    assert estimates(sketch, sketch.build(updates.limit(0), "key", "n"), nobody) == {"nobody": 0}


def test_bad_shape():
    with pytest.raises(ValueError):
        Sketch(width=0)
