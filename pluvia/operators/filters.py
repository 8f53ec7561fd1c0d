"""Row filters, projections of feature lists, top-n and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_station(df: DataFrame, station: str, column: str = "county") -> DataFrame:
    """Equality filter; a table written with ``partitionBy(column)`` is pruned to one folder."""
    return df.filter(F.col(column) == station)


def by_years(df: DataFrame, first: int, last: int, column: str = "year") -> DataFrame:
    """Years from ``first`` to ``last``; on a date or time column as bounds the scan can use."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df.filter(F.col(column).between(first, last))
    low, high = (F.make_date(F.lit(y), F.lit(1), F.lit(1)).cast(kind) for y in (first, last + 1))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def trailing_days(df: DataFrame, column: str, now: str, days: int) -> DataFrame:
    """Rows whose day is at most ``days`` before the day of ``now``.

    The bound is on the raw column, so it reaches the scan.
    """
    start = F.date_sub(F.to_date(F.lit(now)), days)
    return df.filter(F.col(column) >= start.cast(df.schema[column].dataType))


def trailing_from_latest(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows within ``days`` of the newest row; the bound is a scalar subquery."""
    newest = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) >= newest - F.make_dt_interval(F.lit(days)))


def drop_missing(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(required) if required else None)


def active_alerts(rows: DataFrame) -> DataFrame:
    """Counties with rain or a raised risk."""
    raised = F.col("onset_risk").isin("MODERATE", "HIGH")
    return rows.filter((F.col("cum_72hr_mm") > 0) | raised)


def unexpired(snapshot: DataFrame, now: Column) -> DataFrame:
    return snapshot.filter(F.col("expires_at") > now)


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def newest(df: DataFrame, n: int, time: str, tie: str) -> DataFrame:
    """The n newest rows (a top-n report: each task keeps n rows)."""
    return df.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(n)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def sample_by_county(df: DataFrame, fractions: dict[str, float], seed: int) -> DataFrame:
    return df.sampleBy("county", fractions, seed)


def hash_order(row_id: str, seed: int) -> Column:
    """A text that orders rows by chance but the same way each time."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def sample_fixed(df: DataFrame, key: str, row_id: str, n: int, seed: int) -> DataFrame:
    """``n`` rows of each key, all of them where it has fewer: those of smallest hash of ``row_id``.

    Each task keeps its own ``n`` of a key before anything is shuffled, and samples merge: the sample of the union of
    two samples is that of all rows. A null key is a key of its own; equal ids are told apart by their order only.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(hash_order(row_id, seed), row_id))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
