"""Sustained breaches on a live stream: consecutive intervals over a threshold, counted with state.

The first operator closes the intervals of a key and the second counts those that breach. Its state is one
row a key: first and last interval of the run, how many there are, and the worst. A run ends with an interval
that is missing or not over the threshold, and is then reported if it is long enough. A timer in event time
ends a run that nothing follows: it fires when no interval next to the last one can come any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pluvia.session import state_session

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RUN = "first timestamp, last timestamp, intervals bigint, worst double"
COLUMNS = ["breach_start", "breach_end", "intervals", "worst_p95"]


class RunCounter(StatefulProcessor):
    """Runs of at least ``steps`` intervals of ``step_seconds`` whose p95 is over ``threshold``."""

    def __init__(self, threshold: float, steps: int, step_seconds: int) -> None:
        self.threshold, self.steps = threshold, steps
        self.step = pd.Timedelta(seconds=step_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", RUN)

    def _ended(self, key, run) -> Iterator[pd.DataFrame]:
        if run is not None and run[2] >= self.steps:
            yield pd.DataFrame([[key[0], *run]], columns=["endpoint", *COLUMNS])

    def _stored(self):
        if not self.run.exists():
            return None
        first, last, intervals, worst = self.run.get()
        return pd.Timestamp(first), pd.Timestamp(last), intervals, worst

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(rows)).sort_values("minute")
        run = self._stored()
        for minute, p95 in zip(held["minute"], held["p95"]):
            over = p95 > self.threshold
            if run is not None and over and minute == run[1] + self.step:
                run = (run[0], minute, run[2] + 1, max(run[3], p95))
                continue
            yield from self._ended(key, run)
            run = (minute, minute, 1, p95) if over else None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if run is None:
            self.run.clear()
        else:
            self.run.update((run[0].to_pydatetime(), run[1].to_pydatetime(), int(run[2]), float(run[3])))
            self.handle.registerTimer(int((run[1] + 2 * self.step).timestamp() * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._ended(key, self._stored())
        self.run.clear()

    def close(self) -> None:
        pass


def breach_session(spark: SparkSession) -> SparkSession:
    """A session for the counters, whose state store keeps variables and timers."""
    session = state_session(spark)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return session


def interval_p95(samples: DataFrame, time: str, endpoint: str, value: str, length: str, late: str) -> DataFrame:
    """(window, minute, endpoint, p95) of closed intervals; ``minute`` is where one starts."""
    rows = samples.where(F.col(value).isNotNull()).withWatermark(time, late)
    made = rows.groupBy(F.window(time, length), F.col(endpoint).alias("endpoint")).agg(F.percentile(value, 0.95).alias("p95"))
    return made.select(F.col("window.start").alias("minute"), "endpoint", "p95")


def sustained_breaches_live(percentiles: DataFrame, threshold: float, steps: int, step_seconds: int = 60) -> DataFrame:
    """(endpoint, breach_start, breach_end, intervals, worst_p95) of runs that have ended."""
    return percentiles.groupBy("endpoint").transformWithStateInPandas(
        RunCounter(threshold, steps, step_seconds),
        "endpoint string, breach_start timestamp, breach_end timestamp, intervals bigint, worst_p95 double",
        "Append",
        "EventTime",
    )
