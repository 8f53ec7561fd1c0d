"""Places in an order that no single task holds: rows sorted by ranges and written once, then counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.session import new_folder


def numbered(rows: DataFrame, group: str, order: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``group`` with the place ``pos`` in the group, from 0, and the size ``n_group`` of it.

    Rows equal in ``order`` are told apart by their number in the input, which makes the ranges of a
    frequent value divisible. ``group`` is not null; ``order`` should determine ``keep`` for results that repeat.
    """
    path = new_folder(rows.sparkSession, "ranks")
    keys = [group, *order, "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed.select(group, *keep, "_at").write.parquet(path)
    # the upper bits of the number are the partition, the lower ones the place in it
    table = rows.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    runs = table.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")
    shift = (before - F.col("_first")).alias("_shift")
    runs = runs.select("_part", group, shift, F.sum("_rows").over(whole).alias("n_group"))
    known = table.join(runs, ["_part", group]).withColumn("pos", F.col("_at") + F.col("_shift"))
    return known.drop("_part", "_at", "_shift")
