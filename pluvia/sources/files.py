"""Table, CSV and JDBC scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.schemas import CLIMATE_CSV


def read_climate_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered climate CSV with a declared schema (no inference pass)."""
    return spark.read.schema(CLIMATE_CSV).csv(path, header=True).withColumnRenamed("time", "time_str")


def scan(spark: SparkSession, path: str, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Projected parquet scan; a mapping renames (source -> output)."""
    pairs = columns.items() if isinstance(columns, Mapping) else ((c, c) for c in columns)
    return spark.read.parquet(path).select(*[F.col(c).alias(n) for c, n in pairs])


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[str, str],
    partitions: int,
    **options: str,
) -> DataFrame:
    """Relational scan split by ranges of a numeric, date or timestamp column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, **options)
        .options(lowerBound=bounds[0], upperBound=bounds[1], numPartitions=str(partitions))
        .load()
    )


def newest_n_files(df: DataFrame, path: str, n: int) -> DataFrame:
    """Only the n newest files of a folder, by time of change, then name; ``df`` gives the schema.

    The listing has one row per file and no content; n names come back.
    """
    listed = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    newest = listed.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).limit(n)
    names = [r["path"] for r in newest.collect()]
    return df.sparkSession.read.schema(df.schema).parquet(*names) if names else df.limit(0)


def newest_files(df: DataFrame, since: str) -> DataFrame:
    """Rows of a file scan whose file changed at or after ``since`` (files are pruned)."""
    return df.filter(F.col("_metadata.file_modification_time") >= F.lit(since).cast("timestamp"))
