"""Sources: messages, payload arrays, grids, files and the county dimension."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.plans import common
from pluvia.plans.registry import d, day, i, query, ts
from pluvia.plans.tables import sql
from pluvia.session import new_folder, state_session
from pluvia.sources import files, messages, payloads
from pluvia.streaming.jobs import run_together, to_files

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def message_texts(t) -> DataFrame:
    """One JSON message per reading in a ``value`` column, with the reading's id."""
    body = F.struct(
        "county",
        F.date_format("event_time", ISO).alias("timestamp"),
        "precipitation",
        "temperature",
        "soil_moisture",
    )
    return t.readings().select("reading_id", F.to_json(body).alias("value"))


def broken_texts(t) -> DataFrame:
    """The same messages, some of them damaged in each way a producer can."""
    k, v = F.col("reading_id") % 10, F.col("value")
    damaged = (
        F.when(k == 0, F.lit("not json"))
        .when(k == 1, F.regexp_replace(v, '"county"', '"county_name"'))
        .when(k == 2, F.regexp_replace(v, '"timestamp":"[^"]*"', '"timestamp":"bogus"'))
        .when(k == 3, F.regexp_replace(v, '"precipitation":[0-9.E-]+', '"precipitation":"wet"'))
        .when(k == 4, F.regexp_replace(v, r"\}$", ',"extra":1}'))
        .when(k == 5, F.regexp_replace(v, '"timestamp"', '"time"'))
        .otherwise(v)
    )
    return message_texts(t).select("reading_id", damaged.alias("value"))


READING_COLUMNS = (
    f"county, {ts('event_time', 'event_time')}, {d('precipitation', 'precipitation')}, "
    f"{d('temperature', 'temperature')}, {d('soil_moisture', 'soil_moisture')}"
)
READING_FIELDS = ["county", "event_time", "precipitation", "temperature", "soil_moisture"]


@query(
    "src_csv_climate",
    f"""SELECT {d("CAST((l_suppkey % 16) - 12 AS DOUBLE)", "lat")}, {d("CAST(34 + l_partkey % 5 AS DOUBLE)", "lon")},
    {i("l_linenumber", "number")}, 't' || l_orderkey AS time_str, {d("500 + l_partkey % 500", "pressure_hpa")},
    {ts("l_shipdate", "valid_time")}, {d("l_quantity + 273.15", "temperature_k")}, {d("l_quantity", "temperature_c")},
    {i("l_orderkey % 24", "step_hours")} FROM lineitem""",
)
def csv_climate(t):
    rows = t.raw("lineitem").select(
        ((F.col("l_suppkey") % 16) - 12).cast("double").alias("lat"),
        (34 + F.col("l_partkey") % 5).cast("double").alias("lon"),
        F.col("l_linenumber").alias("number"),
        F.concat(F.lit("t"), "l_orderkey").alias("time"),
        (500 + F.col("l_partkey") % 500).cast("double").alias("pressure_hpa"),
        F.col("l_shipdate").cast("timestamp").alias("valid_time"),
        (F.col("l_quantity") + 273.15).alias("temperature_k"),
        F.col("l_quantity").alias("temperature_c"),
        (F.col("l_orderkey") % 24).alias("step_hours"),
    )
    path = new_folder(t.spark, "csv")
    rows.write.csv(path, header=True)
    return files.read_climate_csv(t.spark, path)


@query("src_parquet_scan", f"SELECT l_orderkey AS id, {d('l_quantity', 'temperature_c')} FROM lineitem")
def parquet_scan(t):
    return files.scan(t.spark, f"{t.folder}/lineitem.parquet", {"l_orderkey": "id", "l_quantity": "temperature_c"})


@query(
    "src_table_scan",
    sql(f"SELECT {ts('observation_date', 'ds')}, county, {d('cum_72hr_mm', 'y')} FROM history", "history"),
)
def table_scan(t):
    name = f"historical_onset_{uuid.uuid4().hex}"
    t.history().createOrReplaceTempView(name)
    rows = t.spark.table(name).select(F.col("observation_date").alias("ds"), "county", F.col("cum_72hr_mm").alias("y"))
    t.spark.catalog.dropTempView(name)
    return rows


@query("src_kafka_stream", sql(f"SELECT {READING_COLUMNS} FROM readings", "readings"))
def message_stream(t):
    """The stream decode, fed from landed text files instead of a broker."""
    folder, out = new_folder(t.spark, "messages"), new_folder(t.spark, "decoded")
    message_texts(t).select("value").write.text(folder)
    raw = messages.message_stream(state_session(t.spark), "files", folder)
    parsed = messages.parse_messages(raw)
    run_together([to_files(parsed, out, new_folder(t.spark, "checkpoint"), trigger=None)])
    return t.spark.read.schema(parsed.schema).parquet(out).select(*READING_FIELDS)


@query(
    "src_json_messages",
    sql(
        f"""SELECT {READING_COLUMNS} FROM (SELECT * REPLACE (CASE WHEN reading_id % 10 <> 3 THEN precipitation END AS precipitation)
        FROM readings) WHERE reading_id % 10 NOT IN (0, 1, 2, 5)""",
        "readings",
    ),
)
def json_messages(t):
    return messages.parse_messages(broken_texts(t)).select(*READING_FIELDS)


@query(
    "stream_schema_guard",
    sql(
        f"""SELECT CASE reading_id % 10 WHEN 0 THEN 'no usable fields' WHEN 1 THEN 'missing county' WHEN 2 THEN 'bad timestamp'
        ELSE 'missing timestamp' END AS reject_reason, {i("count(*)", "messages")} FROM readings WHERE reading_id % 10 IN (0, 1, 2, 5) GROUP BY 1""",
        "readings",
    ),
)
def schema_guard(t):
    rejected = messages.rejected_messages(broken_texts(t))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


def _as_text(rows: DataFrame, part: str) -> DataFrame:
    keep = [c for c in rows.columns if c != part]
    return rows.select(*keep, F.to_json(F.struct(part)).alias("payload"))


@query(
    "src_hourly_arrays",
    sql(
        f"""SELECT county, strftime(hour, '%Y-%m-%dT%H:%M') AS time, {d("precipitation", "precipitation")}, {d("temperature", "temperature")},
        {d("soil_moisture", "soil_moisture")}, {d("humidity", "humidity")}, CAST(NULL AS DOUBLE) AS wind_speed FROM hourly""",
        "readings",
        hourly=common.HOURLY,
    ),
)
def hourly_arrays(t):
    texts = _as_text(common.week_payloads(t), "hourly")
    return payloads.hourly_rows(payloads.parse_payload(texts, "payload", "hourly")).drop("payload_id")


@query(
    "src_latest_reading",
    sql(
        f"""SELECT county, {i("payload_id", "payload_id")}, strftime(hour, '%Y-%m-%dT%H:%M') AS timestamp,
        {d("round(precipitation, 4)", "precipitation")}, {d("round(temperature, 4)", "temperature")},
        {d("round(soil_moisture, 4)", "soil_moisture")}, {d("round(humidity, 4)", "humidity")}, CAST(NULL AS DOUBLE) AS wind_speed
        FROM weeks WHERE k = n""",
        "readings",
        hourly=common.HOURLY,
        weeks=common.WEEK_ROWS,
    ),
)
def latest_reading(t):
    texts = _as_text(common.week_payloads(t), "hourly")
    return payloads.latest_reading(payloads.parse_payload(texts, "payload", "hourly"))


@query(
    "src_daily_forecast",
    sql(
        f"""SELECT county, strftime(day, '%Y-%m-%d') AS date, {d("rain", "precipitation_mm")}, {d("hi", "temp_max_c")},
        CAST(NULL AS DOUBLE) AS temp_min_c FROM days""",
        "readings",
        days=common.DAILY,
    ),
)
def daily_forecast(t):
    texts = _as_text(common.daily_payloads(t), "daily")
    return payloads.daily_rows(payloads.parse_payload(texts, "payload", "daily")).drop("payload_id")


@query(
    "src_grid_flatten",
    sql(
        f"""SELECT {day("date", "date")}, {d("lat", "lat")}, {d("lon", "lon")}, {d("avg(temperature_c)", "temperature_k")}
        FROM climate GROUP BY date, lat, lon""",
        "climate",
    ),
)
def grid_flatten(t):
    """Daily fields as lat x lon arrays, each with the axes its cells call for, flattened again."""
    cells = t.climate().groupBy("date", "lat", "lon").agg(F.avg("temperature_c").alias("v"))
    # One grid a day: its cells are the bound of these lists.
    days = cells.groupBy("date").agg(
        F.array_sort(F.collect_set("lat")).alias("latitude"),
        F.array_sort(F.collect_set("lon")).alias("longitude"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("lat", "lon"), "v"))).alias("_v"),
    )
    field = F.transform(
        "latitude",
        lambda y: F.transform("longitude", lambda x: F.try_element_at("_v", F.struct(y.alias("lat"), x.alias("lon")))),
    )
    cubes = days.select("date", "latitude", "longitude", field.alias("t"))
    return payloads.flatten_grid(cubes, "t", "temperature_k", keep=["date"])


@query(
    "src_county_dim",
    sql(
        f"""SELECT county, {d("lat", "lat")}, {d("lon", "lon")}, {i("count(reading_id)", "readings")}
        FROM counties LEFT JOIN readings USING (county) GROUP BY county, lat, lon""",
        "readings",
        "counties",
    ),
)
def county_dimension(t):
    counts = t.readings().groupBy("county").agg(F.count(F.lit(1)).alias("readings"))
    return common.counties(t).join(counts, "county", "left").withColumn(
        "readings", F.coalesce("readings", F.lit(0))
    )
