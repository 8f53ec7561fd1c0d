"""Starting, sinking, concurrent running and lag of streaming queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from pluvia.operators.joins import live_vs_baseline
from pluvia.operators.sketch import Sketch, heavy_hitters, heavy_keys, merge_heavy
from pluvia.schemas import LAG_CRITICAL
from pluvia.sinks.writers import SnapshotStore, StateStore, alert_payloads, run_of, write_batch
from pluvia.streaming.windows import flag_onsets

TRIGGER = "10 seconds"
CELLS = T.StructType(
    [
        T.StructField("row_id", T.IntegerType()),
        T.StructField("col_id", T.IntegerType()),
        T.StructField("cnt", T.LongType()),
    ]
)
FREQUENT = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("cnt", T.LongType()),
        T.StructField("lost", T.LongType()),
    ]
)


def _triggered(writer, trigger: str | None):
    """``None`` drains what is there and stops (backfill); else a fixed interval."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: str | None = TRIGGER,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append closed windows to files, exactly once per checkpoint."""
    writer = (
        df.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return _triggered(writer, trigger).start()


def to_console(df: DataFrame, checkpoint: str, trigger: str | None = TRIGGER) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("console").option("truncate", "false")
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


@dataclass
class OnsetSink:
    """One micro-batch of 72-hour totals to all of its destinations.

    Every write is keyed by the run, which is the checkpoint's, and the batch number: a batch
    that runs again after a failure replaces its own output, and a new checkpoint on the same
    root adds to what is there. The snapshot and the cells of the sketch are small states that
    each batch renews. ``top`` counties by rain are reported per batch, under ``top_counties``.
    """

    spark: SparkSession
    root: str
    now: Callable[[], Column] = F.current_timestamp
    publish: Callable[[DataFrame], None] | None = None
    sketch: Sketch = field(default_factory=Sketch)
    run: str = "0"
    top: int = 5
    heavy: int = 100

    def __post_init__(self) -> None:
        self.snapshots = SnapshotStore(self.spark, f"{self.root}/snapshot")
        self.cells = StateStore(self.spark, f"{self.root}/sketch", CELLS)
        self.frequent = StateStore(self.spark, f"{self.root}/frequent", FREQUENT)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        flagged = flag_onsets(batch).withColumn("alert_timestamp", F.col("window_end")).persist()
        try:
            if flagged.isEmpty():
                return
            alerts = flagged.filter("onset_flag")
            if self.publish:
                self.publish(alerts)
            write_batch(alert_payloads(alerts), f"{self.root}/payloads", self.run, batch_id, "text")
            self.snapshots.upsert(alerts, self.run, batch_id, self.now())
            write_batch(flagged, f"{self.root}/onset_alerts", self.run, batch_id)
            report = wettest(flagged, self.top)
            write_batch(report, f"{self.root}/top_counties", self.run, batch_id)
            counts = self.sketch.build(flagged, "county", "event_count")
            self.cells.write(lambda before: self.sketch.merge(before.unionByName(counts)), self.run, batch_id)
            found = heavy_hitters(flagged, "county", self.heavy, "event_count")
            self.frequent.write(lambda before: merge_heavy(before, found, k=self.heavy), self.run, batch_id)
            write_batch(self.estimates(), f"{self.root}/top_estimates", self.run, batch_id)
        finally:
            flagged.unpersist()

    def sketch_cells(self) -> DataFrame:
        return self.cells.read()

    def estimates(self) -> DataFrame:
        """(county, estimate): the keys of most events so far, of all that the summary holds."""
        keys = heavy_keys(self.frequent.read()).select("key", F.col("key").alias("pos"))
        return self.sketch.top_k(self.cells.read(), keys, self.top).select(F.col("key").alias("county"), "estimate")


@dataclass
class BaselineSink:
    """Closed windows of a stream next to what is expected of their county and month.

    ``history`` is called for each batch, so a renewed baseline shows in the next one.
    """

    root: str
    history: Callable[[], DataFrame]
    run: str = "0"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        live = batch.select("county", "window_start", "cum_72hr_mm")
        write_batch(live_vs_baseline(live, self.history()).drop("month"), self.root, self.run, batch_id)


def to_baseline_sink(
    totals: DataFrame, sink: BaselineSink, checkpoint: str, trigger: str | None = TRIGGER
) -> StreamingQuery:
    sink.run = run_of(totals.sparkSession, checkpoint)
    writer = totals.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def wettest(flagged: DataFrame, top: int) -> DataFrame:
    """The counties of largest 72-hour total in a batch, each with its largest window."""
    columns = F.struct("cum_72hr_mm", "window_end", "onset_flag")
    best = flagged.groupBy("county").agg(F.max(columns).alias("b")).select("county", "b.*")
    return best.orderBy(F.desc("cum_72hr_mm"), "county").limit(top)


def to_onset_sink(
    totals: DataFrame, sink: OnsetSink, checkpoint: str, trigger: str | None = TRIGGER
) -> StreamingQuery:
    sink.run = run_of(sink.spark, checkpoint)
    writer = (
        totals.writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def run_together(queries: Sequence[StreamingQuery], poll_seconds: float = 0.2) -> None:
    """Wait until every query has ended; if one fails, stop the others and raise its error."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
            time.sleep(poll_seconds)
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def lag_report(offsets: DataFrame, critical_above: int = LAG_CRITICAL, *keys: str) -> DataFrame:
    """Messages behind, summed over partitions; a partition never committed counts from zero."""
    lag = F.sum(F.col("end_offset") - F.coalesce("committed_offset", F.lit(0)))
    return offsets.groupBy(*keys, "topic").agg(lag.alias("lag")).withColumn(
        "status", F.when(F.col("lag") > critical_above, "CRITICAL").otherwise("HEALTHY")
    )


OFFSETS = "query string, batch bigint, source string, start string, end string, latest string, rows bigint"


class OffsetLog(StreamingQueryListener):
    """Offsets of every source of running queries, batch by batch, as they report them.

    Rows wait on the driver until ``table`` or ``flush`` takes them; there is one per source and batch.
    """

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        p = event.progress

        def text(offset) -> str | None:
            return None if offset in (None, "None") else str(offset).replace("'", '"')

        for s in p.sources:
            self.rows.append((p.name, p.batchId, s.description, text(s.startOffset), text(s.endOffset), text(s.latestOffset), s.numInputRows))

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def heard_all_of(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait for the last report of a query that has ended; reports come a little later than batches."""
        return self._ended[str(query.runId)].wait(seconds)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), OFFSETS)

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append what has come in to a table and forget it."""
        taken, self.rows = self.rows, []
        if taken:
            spark.createDataFrame(taken, OFFSETS).coalesce(1).write.mode("append").parquet(path)


def message_lag(offsets: DataFrame, critical_above: int = LAG_CRITICAL) -> DataFrame:
    """Messages behind per query, batch and topic, of sources that report {topic: {partition: offset}}."""
    per_topic = "map<string, map<string, bigint>>"
    rows = offsets.where(F.col("latest").isNotNull()).select(
        "query", "batch", F.from_json("end", per_topic).alias("done"), F.explode(F.from_json("latest", per_topic)).alias("topic", "ends")
    )
    each = rows.select("query", "batch", "topic", "done", F.explode("ends").alias("partition", "end_offset"))
    done = F.try_element_at(F.try_element_at("done", F.col("topic")), F.col("partition"))
    return lag_report(each.withColumn("committed_offset", done), critical_above, "query", "batch")


def file_lag(offsets: DataFrame, checkpoint: str, folder: str, source: int = 0) -> DataFrame:
    """(query, batch, rows, files_read, files_behind, bytes_behind) of a file source, batch by batch.

    The checkpoint tells which files went into which of the source's own batches, whose number is the end offset of
    a progress report; what the folder holds now and a batch had not read is behind it.
    """
    spark = offsets.sparkSession
    log = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId bigint")
    read = log.select(_name(entry["path"]).alias("file"), entry["batchId"].alias("taken")).distinct()
    held = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select(_name(F.col("path")).alias("file"), "length")
    files = held.join(read, "file", "left").groupBy("taken").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    steps = offsets.select("query", "batch", "rows", F.get_json_object("end", "$.logOffset").cast("bigint").alias("at")).where(F.col("at").isNotNull())
    # running totals over the source's batches; a batch of the query is one of them
    order = Window.orderBy("taken")
    total = files.agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    known = files.where(F.col("taken").isNotNull()).select(
        F.col("taken").alias("at"), F.sum("files").over(order).alias("files_read"), F.sum("bytes").over(order).alias("_bytes")
    )
    whole, size = total.select("files").scalar(), total.select("bytes").scalar()
    return steps.join(known, "at").select(
        "query", "batch", "rows", "files_read", (whole - F.col("files_read")).alias("files_behind"), (size - F.col("_bytes")).alias("bytes_behind")
    )


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


class ProgressLog(StreamingQueryListener):
    """Progress figures of running queries: the last batches, and totals since the start.

    ``totals`` maps the name of a query to its batches, rows and late rows dropped.
    """

    def __init__(self, keep: int = 1000) -> None:
        self.keep, self.rows, self.totals = keep, [], {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rows.append((p.name, p.batchId, p.numInputRows, p.processedRowsPerSecond, dropped))
        del self.rows[: -self.keep]
        batches, rows, late = self.totals.get(p.name, (0, 0, 0))
        self.totals[p.name] = (batches + 1, rows + p.numInputRows, late + dropped)

    def onQueryTerminated(self, event) -> None:
        pass
