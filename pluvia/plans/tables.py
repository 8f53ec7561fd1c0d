"""The given tables read as sensor data, once for Spark and once as SQL text.

Each reading-like table has a DataFrame form here and a common table expression of
the same name in ``CTE``; the oracle query of every plan starts from the latter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.schemas import COUNTIES, COUNTY_NAMES
from pluvia.session import state_session

DAY_MICROS = 86_400_000_000
# "Now" for trailing filters over the order history; a parameter, never the clock.
HISTORY_NOW = "2001-08-01 00:00:00"

_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in COUNTY_NAMES) + "]"


def _county(user: str):
    names = F.array(*[F.lit(n) for n in COUNTY_NAMES])
    return F.element_at(names, (F.col(user) % 10 + 1).cast("int"))


def readings_from(events: DataFrame) -> DataFrame:
    """Canonical readings from the event rows (batch or stream)."""
    ts = F.col("ts").cast("timestamp")
    day = F.floor(F.unix_micros(ts) / F.lit(DAY_MICROS))
    dry = (day + F.col("user_id") % 10) % 9 == 0
    return events.select(
        _county("user_id").alias("county"),
        ts.alias("event_time"),
        F.col("event_id").alias("reading_id"),
        F.when(dry, 0.0).otherwise(F.col("value") * 0.004).alias("precipitation"),
        (15 + F.col("event_id") % 18).cast("double").alias("temperature"),
        (0.05 + (F.col("event_id") % 41) / 100.0).alias("soil_moisture"),
        F.get_json_object("props", "$.k").cast("int").alias("humidity"),
    )


class Tables:
    """Readers over one scale-factor folder; every method is lazy."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def event_stream(self) -> DataFrame:
        """The same readings as a file stream, whether the table is one file or a folder.

        The files are in no time order, so a drained stream takes them as one batch:
        several would move the watermark past readings still to come.
        """
        reader = state_session(self.spark).readStream.schema(self.raw("events").schema)
        # A file stream takes folders or patterns, not a plain file name.
        return readings_from(reader.parquet(f"{self.folder}/events.parque[t]"))

    def readings(self) -> DataFrame:
        return readings_from(self.raw("events"))

    def climate(self) -> DataFrame:
        """Gridded temperatures from the order lines; (date, id1..id4) orders a location."""
        return self.raw("lineitem").select(
            ((F.col("l_suppkey") % 16) - 12).cast("double").alias("lat"),
            (34 + F.col("l_partkey") % 5).cast("double").alias("lon"),
            F.to_date("l_shipdate").alias("date"),
            F.col("l_quantity").alias("temperature_c"),
            F.col("l_orderkey").alias("id1"),
            F.col("l_linenumber").cast("bigint").alias("id2"),
            F.col("l_partkey").alias("id3"),
            F.col("l_suppkey").alias("id4"),
        )

    def enriched(self) -> DataFrame:
        """Model input rows: ds, county, y (deg C), surface pressure, kelvin."""
        return self.readings().select(
            F.col("event_time").alias("ds"),
            "reading_id",
            "county",
            F.col("temperature").alias("y"),
            (1000 + F.col("reading_id") % 30).cast("double").alias("surface_pressure"),
            (F.col("temperature") + 273.15).alias("temp_k"),
        )

    def history(self) -> DataFrame:
        cum = F.col("o_totalprice") / 10000
        return self.raw("orders").select(
            F.col("o_orderkey").alias("observation_id"),
            F.col("o_orderdate").alias("observation_date"),
            _county("o_custkey").alias("county"),
            cum.alias("cum_72hr_mm"),
            (cum >= 20).alias("onset_flag"),
        )


def _cte_county(col: str) -> str:
    return f"{_NAMES_SQL}[CAST({col} % 10 + 1 AS BIGINT)]"


CTE = {
    "readings": f"""readings AS (
  SELECT {_cte_county('user_id')} AS county, ts AS event_time, event_id AS reading_id,
    CASE WHEN (CAST(floor(epoch(ts) / 86400) AS BIGINT) + user_id % 10) % 9 = 0
         THEN CAST(0 AS DOUBLE) ELSE value * CAST(0.004 AS DOUBLE) END AS precipitation,
    CAST(15 + event_id % 18 AS DOUBLE) AS temperature,
    CAST(0.05 AS DOUBLE) + (event_id % 41) / CAST(100 AS DOUBLE) AS soil_moisture,
    CAST(props->>'$.k' AS BIGINT) AS humidity
  FROM events)""",
    "climate": """climate AS (
  SELECT CAST((l_suppkey % 16) - 12 AS DOUBLE) AS lat, CAST(34 + l_partkey % 5 AS DOUBLE) AS lon,
    CAST(l_shipdate AS DATE) AS date, l_quantity AS temperature_c,
    l_orderkey AS id1, CAST(l_linenumber AS BIGINT) AS id2, l_partkey AS id3, l_suppkey AS id4
  FROM lineitem)""",
    "enriched": f"""enriched AS (
  SELECT ts AS ds, event_id AS reading_id, {_cte_county('user_id')} AS county,
    CAST(15 + event_id % 18 AS DOUBLE) AS y, CAST(1000 + event_id % 30 AS DOUBLE) AS surface_pressure,
    CAST(15 + event_id % 18 AS DOUBLE) + CAST(273.15 AS DOUBLE) AS temp_k
  FROM events)""",
    "history": f"""history AS (
  SELECT o_orderkey AS observation_id, o_orderdate AS observation_date,
    {_cte_county('o_custkey')} AS county, o_totalprice / 10000 AS cum_72hr_mm,
    o_totalprice / 10000 >= 20 AS onset_flag
  FROM orders)""",
    "counties": "counties AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', CAST({la} AS DOUBLE), CAST({lo} AS DOUBLE))" for n, la, lo in COUNTIES)
    + ") AS c(county, lat, lon))",
}


def sql(body: str, *uses: str, **extra: str) -> str:
    """An oracle query over the named table expressions (plus ``name=select`` ones, each worked out once)."""
    parts = [CTE[u] for u in uses] + [f"{k} AS MATERIALIZED (\n{v})" for k, v in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body
