"""Collects queries and their oracle SQL; each plan module registers its own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.plans.tables import Tables

DAY_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Sums differ in their last bits with the order of addition. The nudge keeps values that
# lie exactly between two decimals (12.34565) from rounding either way.
NUDGE = 1e-8


@dataclass(frozen=True)
class Query:
    plan: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return present(self.plan(Tables(spark, folder)))


QUERIES: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    """Register a plan under ``key``."""

    def register(plan: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = Query(plan, oracle)
        return plan

    return register


def present(df: DataFrame) -> DataFrame:
    """Comparable result types: BIGINT, 4-decimal DOUBLE, text dates and times.

    A projection on top of the finished plan; thresholds are compared before it.
    """
    shown = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") + NUDGE, 4)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, DAY_FORMAT)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIME_FORMAT)
        shown.append(c.alias(field.name))
    return df.select(*shown)


# DuckDB forms of the same presentation.
def d(expr: str, name: str) -> str:
    # Adding zero turns a rounded -0.0 into 0.0.
    return f"round(CAST({expr} AS DOUBLE) + {NUDGE!r}, 4) + CAST(0 AS DOUBLE) AS {name}"


def i(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def day(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"


def ts(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"
