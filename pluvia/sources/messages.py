"""Weather messages: bytes or text in, typed readings out, for batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia.schemas import MESSAGE, MESSAGE_V0

_ZONED = r"(Z|[+-]\d{2}:?\d{2})$"
_MINUTE_ZONED = r"(T\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})$"


def event_time(text: Column, source_tz: str = "UTC") -> Column:
    """ISO text to an instant, null if unparseable; ``source_tz`` is for texts without a zone."""
    # Spark reads a zone only after seconds; texts that end at the minute get ":00".
    padded = F.regexp_replace(text, _MINUTE_ZONED, "$1:00$2")
    parsed = F.coalesce(text.try_cast("timestamp"), padded.try_cast("timestamp"))
    if source_tz == "UTC":
        return parsed
    return F.when(text.rlike(_ZONED), parsed).otherwise(F.to_utc_timestamp(parsed, source_tz))


def _canonical(parsed: DataFrame) -> DataFrame:
    """Older field names to current ones; fields the message lacks stay null."""
    if "rainfall_mm" not in parsed.columns:
        return parsed
    return parsed.select(
        "message",
        "county",
        "timestamp",
        F.col("rainfall_mm").alias("precipitation"),
        F.col("temperature_c").alias("temperature"),
        F.lit(None).cast("double").alias("soil_moisture"),
    )


def decode(raw: DataFrame, schema: T.StructType = MESSAGE, source_tz: str = "UTC") -> DataFrame:
    """Every message with its fields, event time and, where unusable, a reject reason.

    A wrong-typed measure becomes null and keeps the message; text that is no JSON,
    a missing county or timestamp, and an unreadable timestamp reject it.
    """
    text = raw.select(F.col("value").cast("string").alias("message"))
    # A generator, unlike a projection, keeps filters above it: each text is parsed once.
    flat = _canonical(text.select("message", F.inline(F.array(F.from_json("message", schema)))))
    reason = (
        F.when(F.col("county").isNull() & F.col("timestamp").isNull(), "no usable fields")
        .when(F.col("county").isNull(), "missing county")
        .when(F.col("timestamp").isNull(), "missing timestamp")
        .when(F.col("event_time").isNull(), "bad timestamp")
    )
    timed = flat.withColumn("event_time", event_time(F.col("timestamp"), source_tz))
    return timed.withColumn("reject_reason", reason)


def parse_messages(
    raw: DataFrame, schema: T.StructType = MESSAGE, source_tz: str = "UTC"
) -> DataFrame:
    """The accepted messages as typed readings."""
    return (
        decode(raw, schema, source_tz)
        .filter(F.col("reject_reason").isNull())
        .select(
            "county", "timestamp", "precipitation", "temperature", "soil_moisture", "event_time"
        )
    )


def rejected_messages(raw: DataFrame, source_tz: str = "UTC") -> DataFrame:
    return (
        decode(raw, MESSAGE, source_tz)
        .filter(F.col("reject_reason").isNotNull())
        .select("message", "reject_reason")
    )


def message_stream(
    spark: SparkSession,
    kind: str,
    location: str,
    topic: str = "raw-weather-stream",
    starting_offsets: str = "latest",
) -> DataFrame:
    """A stream with a ``value`` column: ``kafka`` (brokers) or ``files`` (folder of text lines).

    ``starting_offsets="earliest"`` replays a topic; a folder is always read from its start.
    """
    if kind == "files":
        return spark.readStream.text(location)
    if kind == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", "false")
            .load()
        )
    raise ValueError(f"unknown stream kind {kind!r}")


__all__ = [
    "MESSAGE",
    "MESSAGE_V0",
    "decode",
    "event_time",
    "message_stream",
    "parse_messages",
    "rejected_messages",
]
