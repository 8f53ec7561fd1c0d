"""The registered queries of this folder, one for each operator, over whole tables."""

from __future__ import annotations

import os
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import pluvia
from pluvia.llm import align, ann, bpe, langid, lm, merkle, mixing, packing, quality, sharding, simhash, topk, weighted

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package; where it is not installed they need its place."""
    root = str(Path(pluvia.__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


QUERIES = {
    "op1_packing": lambda s, d: packing.op1_packing(_table(s, d, "documents"), _vocabulary()),
    "op2_topk": lambda s, d: topk.op2_topk(_table(s, d, "embeddings")),
    "op3_ann": lambda s, d: ann.op3_ann(_table(s, d, "embeddings")),
    "op4_langid": lambda s, d: langid.op4_langid(_table(s, d, "documents")),
    "op5_sharding": lambda s, d: sharding.op5_sharding(_table(s, d, "documents")),
    "op6_mixing": lambda s, d: mixing.op6_mixing(_table(s, d, "documents"), _table(s, d, "labels")),
    "op7_simhash": lambda s, d: simhash.op7_simhash(_table(s, d, "documents")),
    "op8_quality": lambda s, d: quality.op8_quality(_table(s, d, "documents"), _table(s, d, "labels")),
    "op9_bpe": lambda s, d: bpe.op9_bpe(_table(s, d, "documents"), _vocabulary()),
    "op10_backoff": lambda s, d: lm.op10_backoff(_table(s, d, "documents")),
    "op10_backoff_order3": lambda s, d: lm.op10_backoff_order3(_table(s, d, "documents")),
    "op11_align": lambda s, d: align.op11_align(_table(s, d, "documents"), _vocabulary(), _vocabulary(PIECES)),
    "op12_merkle": lambda s, d: merkle.op12_merkle(_table(s, d, "documents")),
    "op13_fingerprint": lambda s, d: weighted.op13_fingerprint(_table(s, d, "documents")),
}

ORACLE_SQL = {
    "op2_topk": topk.ORACLE,
    "op10_backoff": lm.ORACLE,
    "op10_backoff_order3": lm.ORACLE_ORDER3,
    "op12_merkle": merkle.ORACLE,
}
