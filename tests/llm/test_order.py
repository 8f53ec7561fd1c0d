"""A query that scores with trigrams is registered, and trigrams change its scores."""

from pluvia.llm import lm
from pluvia.llm.queries import QUERIES


def test_order_three_counts_trigrams(spark):
    assert "op10_backoff_order3" in QUERIES
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "x b d")], "doc_id long, text string")
    of = lambda df: {r["doc_id"]: r["log_score"] for r in df.collect()}
    two, three = of(lm.op10_backoff(docs)), of(lm.op10_backoff_order3(docs))
    # elsewhere (a b) stands once, before c: ln 1; b stands twice, once before c: ln 1/2
    assert abs(three[1] - two[1] - 0.6931) < 2e-4
