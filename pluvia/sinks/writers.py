"""Batch sinks: files, tables, alert payloads and the latest-per-county snapshot."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.schemas import SNAPSHOT, SNAPSHOT_TTL_DAYS
from pluvia.sources.payloads import forecast_onset

TABLE_BATCH = 5000


def overwrite_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_batch(df: DataFrame, path: str, run: str, batch_id: int, fmt: str = "parquet") -> None:
    """Append a micro-batch under its own folder; a repeated batch of the same run replaces itself.

    A run is one checkpoint: batch numbers start again at zero with a new one.
    """
    df.write.mode("overwrite").format(fmt).save(f"{path}/run={run}/batch_id={batch_id}")


RUN = "run string, started long"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint stands for, kept inside its folder.

    Ids sort by the time a run began: that time in milliseconds comes first.
    """
    place = f"{checkpoint}/pluvia-run"
    began = time.time_ns() // 1_000_000
    fresh = spark.createDataFrame([(f"{began:015d}-{uuid.uuid4().hex[:8]}", began)], RUN)
    fresh.coalesce(1).write.mode("ignore").parquet(place)
    return spark.read.schema(RUN).parquet(place).first()["run"]


def table_name_for(file_name: str) -> str:
    return file_name.replace(".grib", "").replace("-", "_").lower()


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create or replace a catalog table from the frame (also the create-table-as form)."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def replace_jdbc_table(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a relational table, inserting in chunks."""
    df.write.mode("overwrite").format("jdbc").options(
        url=url, dbtable=table, batchsize=str(TABLE_BATCH), **options
    ).save()


def alert_payloads(alerts: DataFrame) -> DataFrame:
    """The message body of each alert in a ``value`` column."""
    body = F.struct("county", "alert_timestamp", "cum_72hr_mm", "onset_flag")
    return alerts.select(F.to_json(body).alias("value"))


def publish_alerts(alerts: DataFrame, brokers: str, topic: str = "onset-alerts") -> None:
    alert_payloads(alerts).write.format("kafka").option("kafka.bootstrap.servers", brokers).option(
        "topic", topic
    ).save()


def archive_raw(payloads: DataFrame, path: str, source: str, fetched: Column, run: str) -> None:
    """Land raw payloads by county and date, with a ``_meta`` struct and their onset signals.

    ``run`` names the job; a job that runs again replaces what it had landed.
    """
    meta = F.struct(
        "county",
        F.date_format(fetched, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"),
        F.lit(source).alias("source"),
    )
    rows = forecast_onset(payloads, keep_payload=True)
    rows.withColumns({"_meta": meta, "date": F.to_date(fetched)}).write.mode("overwrite").partitionBy(
        "county", "date"
    ).json(f"{path}/run={run}")


def upsert_latest(previous: DataFrame, alerts: DataFrame, now: Column) -> DataFrame:
    """One row per county, the newest alert wins; it expires seven days after ``now``."""
    fresh = alerts.select(
        "county",
        "alert_timestamp",
        "cum_72hr_mm",
        "onset_flag",
        (now + F.make_dt_interval(F.lit(SNAPSHOT_TTL_DAYS))).alias("expires_at"),
        now.alias("ingested_at"),
    )
    values = [f.name for f in SNAPSHOT if f.name != "county"]
    newest = F.max_by(F.struct(*values), F.struct("alert_timestamp", "ingested_at", "cum_72hr_mm"))
    return (
        previous.unionByName(fresh).groupBy("county").agg(newest.alias("_row")).select("county", "_row.*")
    )


VERSION = (
    T.StructField("run", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("_no", T.IntegerType()),
)


class StateStore:
    """A small table that is renewed from its own last state, in two slots.

    Version (run, batch) is built on the newest other version and replaces the older slot,
    so that a batch that runs again gives the same version again and the version before it
    stays readable meanwhile. Two small files are read however many versions there were.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.stored = T.StructType([*schema, *VERSION])
        for slot in (0, 1):
            spark.createDataFrame([], self.stored).write.mode("ignore").parquet(f"{path}/slot={slot}")

    def _slots(self) -> DataFrame:
        # The schema is given, so the slot that is being replaced may be absent.
        schema = T.StructType([*self.stored, T.StructField("slot", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def _versions(self) -> list:
        """(run, batch, slot), newest first: two at most."""
        found = self._slots().groupBy("run", "batch", "slot").count().collect()
        return sorted(((r["run"], r["batch"], r["slot"]) for r in found), reverse=True)

    def read(self) -> DataFrame:
        return self._version(next(iter(self._versions()), None))

    def _version(self, version: tuple | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self._slots().where(F.col("slot") == version[2]).where(F.col("_no").isNotNull()).select(*self.schema.names)

    def write(self, renew: Callable[[DataFrame], DataFrame], run: str, batch: int) -> None:
        """Store ``renew(state before this batch)``."""
        versions = self._versions()
        again = [v for v in versions if v[:2] == (run, batch)]
        before = next((v for v in versions if v[:2] != (run, batch)), None)
        if again:
            slot = again[0][2]
        else:
            slot = 1 - before[2] if before else 0
        version = {"run": F.lit(run), "batch": F.lit(batch).cast("long"), "_no": F.lit(1)}
        # An empty state still has a version: one row that is no row of the table.
        mark = self.spark.createDataFrame([(run, batch)], "run string, batch long")
        rows = renew(self._version(before)).withColumns(version).unionByName(mark, allowMissingColumns=True)
        rows.select(*self.stored.names).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/slot={slot}")


class SnapshotStore(StateStore):
    """The latest alert of every county; expired ones are left out when it is renewed."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__(spark, path, SNAPSHOT)

    def upsert(self, alerts: DataFrame, run: str, batch: int, now: Column) -> None:
        self.write(lambda before: upsert_latest(before, alerts, now).where(F.col("expires_at") > now), run, batch)
