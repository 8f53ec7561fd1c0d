"""The stages on rows with every awkward value, and the whole run on the smallest tables."""

import os

import pytest

import corpus_pipeline
from pluvia.llm.simhash import near_duplicates

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")
AWKWARD = [
    (None, "A text without a number, but with words.", None, None, None, "x"),
    (900_001, None, "en", "src0", 0, "x"),
    (900_002, "", "en", "src0", 0, None),
    (900_003, "12 !! 34", None, "src0", 8, "x"),
    (900_004, "word " * 40_000, "en", None, None, "x"),
    (900_005, "of the and in to", "en", "src0", 16, "x"),
    (900_005, "of the and in to", "en", "src0", 16, "x"),
]
# names that the stages use themselves
CLASHING = """lang_score _has_letter _quality score quality y domain tokens rate p_plain p_poor p_toxic _time
              _row _id _best held any c3 one two node root place bands best group own""".split()


@pytest.fixture(scope="module")
def docs(spark):
    from pyspark.sql import functions as F

    base = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("lang_pred", F.lit("own"))
    odd = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")
    both = base.unionByName(odd)
    for name in CLASHING:
        both = both.withColumn(name, F.concat_ws("/", F.lit(name), F.xxhash64("doc_id", "text")))
    return both.cache()


def test_stages_keep_columns_and_clean_documents(spark, docs):
    had = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER).cache()
        assert after.dtypes == docs.dtypes, name
        assert after.distinct().exceptAll(docs.distinct()).count() == 0, name  # no value of a column is replaced
        if name == "language":
            gone = {r["doc_id"] for r in docs.join(after, "doc_id", "left_anti").collect()}
            assert {900_001, 900_002, 900_003} <= gone and len(gone) <= 0.02 * had + 4
        if name == "near_duplicates":
            groups = near_duplicates(docs).select("component_id").distinct().count()
            assert after.count() == groups
        if name == "mixture":
            assert after.distinct().count() == docs.distinct().count() and after.count() >= docs.count()
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count() and {"ids_sha256", "decoded_sha256", "n_tokens"} <= set(last.columns)


def test_empty_table(spark, docs):
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0, name


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert 0 < out.count()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
