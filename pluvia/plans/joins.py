"""Enrichment, serving and layer-merging joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.functions.weather import county_from_coord
from pluvia.operators import joins as j
from pluvia.plans import common
from pluvia.plans.projections import COUNTY_SQL
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.tables import sql


@query(
    "join_enrich_coords",
    sql(
        f"SELECT c.id1, c.id2, m.county, {d('c.temperature_c', 'y')} FROM climate c JOIN mapping m ON c.lat = m.lat AND c.lon = m.lon",
        "climate",
        mapping=f"SELECT lat, lon, {COUNTY_SQL} AS county FROM (SELECT DISTINCT lat, lon FROM climate)",
    ),
)
def enrich_coords(t):
    coords = t.climate().select("lat", "lon").distinct()
    mapping = coords.withColumn("county", county_from_coord(F.col("lat"), F.col("lon")))
    rows = j.enrich_with_county(t.climate(), mapping)
    return rows.select("id1", "id2", "county", F.col("temperature_c").alias("y"))


@query(
    "join_risk_map",
    sql(
        f"""SELECT county, {d("lat", "lat")}, {d("lon", "lon")}, {d("coalesce(cum_72hr_mm, 0)", "cum_72hr_mm")},
        {ts("alert_timestamp", "alert_timestamp")} FROM counties LEFT JOIN live USING (county)""",
        "readings",
        "counties",
        **common.SERVING,
    ),
)
def risk_map(t):
    rows = j.risk_map_rows(common.counties(t), common.live(t))
    return rows.drop("onset_flag")


@query(
    "join_ml_probability",
    sql(
        f"""SELECT county, {d("cum_72hr_mm", "cum_72hr_mm")}, {d("ml_probability", "ml_probability")}
        FROM live LEFT JOIN scores USING (county)""",
        "readings",
        **common.SERVING,
    ),
)
def ml_probability(t):
    rows = j.with_model_probability(common.live(t), common.scores(t))
    return rows.select("county", "cum_72hr_mm", "ml_probability")


@query(
    "join_actual_vs_forecast",
    sql(
        f"SELECT county, {ts('hour', 'hour')}, {d('y', 'y')}, {d('yhat', 'yhat')}, {d('y - yhat', 'residual')} FROM pairs",
        "readings",
        hourly=common.HOURLY,
        pairs=common.PAIRS,
    ),
)
def actual_vs_forecast(t):
    actual = common.hourly(t).select(
        "county", "hour", F.hour("hour").alias("hour_of_day"), F.col("temperature").alias("y")
    )
    forecast = actual.groupBy("county", "hour_of_day").agg(F.avg("y").alias("yhat"))
    rows = j.actual_vs_forecast(actual, forecast, ["county", "hour_of_day"])
    return rows.select("county", "hour", "y", "yhat", "residual")


@query(
    "join_batch_speed_merge",
    sql(
        f"""SELECT county, {ts("window_start", "window_start")},
        CASE WHEN window_start < TIMESTAMP '2024-01-16' THEN 'batch' ELSE 'speed' END AS layer,
        {d("CASE WHEN window_start < TIMESTAMP '2024-01-16' THEN cum_72hr_mm ELSE cum_72hr_mm * 2 END", "cum_72hr_mm")},
        {i("event_count", "event_count")} FROM windows_72h""",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def batch_speed_merge(t):
    rows = common.windows_72h(t).select("county", "window_start", "cum_72hr_mm", "event_count")
    batch = rows.filter(F.col("window_start") < F.lit("2024-01-16").cast("timestamp"))
    # The speed layer overlaps the batch layer and differs, so the winner shows.
    speed = rows.withColumn("cum_72hr_mm", F.col("cum_72hr_mm") * 2)
    return j.merge_batch_and_speed(batch, speed)


@query(
    "join_live_vs_baseline",
    sql(
        f"""SELECT w.county, {ts("window_start", "window_start")}, {d("w.cum_72hr_mm", "cum_72hr_mm")}, {d("expected_mm", "expected_mm")},
        {d("w.cum_72hr_mm - expected_mm", "difference_mm")}, {d("w.cum_72hr_mm / expected_mm", "ratio")}
        FROM windows_72h w LEFT JOIN baseline b ON w.county = b.county AND month(w.window_start) = b.month""",
        "readings",
        "history",
        windows_72h=common.WINDOWS_72H,
        baseline="SELECT county, month(observation_date) AS month, avg(cum_72hr_mm) AS expected_mm FROM history GROUP BY ALL",
    ),
)
def live_vs_baseline(t):
    live = common.windows_72h(t).select("county", "window_start", "cum_72hr_mm")
    return j.live_vs_baseline(live, t.history()).drop("month")
