"""Risk scores and serving views."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.functions import risk
from pluvia.operators import filters, serving
from pluvia.operators.windows import latest_per
from pluvia.plans import common
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.tables import sql

SCORED_ON = "2024-02-01"


def signals(t):
    """Per county and day: scaled rain and two probability-like means, one with gaps."""
    rows = t.readings().groupBy("county", F.to_date("event_time").alias("day")).agg(
        (F.sum("precipitation") * 4).alias("cum"),
        (F.avg("soil_moisture") * 2).alias("p1"),
        (F.avg("humidity") / 100).alias("p2"),
    )
    return rows.withColumn("p1", F.when(F.dayofmonth("day") % 5 != 0, F.col("p1")))


SIGNALS = """SELECT county, CAST(event_time AS DATE) AS day, sum(precipitation) * 4 AS cum,
  CASE WHEN day(CAST(event_time AS DATE)) % 5 <> 0 THEN avg(soil_moisture) * 2 END AS p1, avg(humidity) / 100 AS p2
FROM readings GROUP BY county, CAST(event_time AS DATE)"""
DAY = "strftime(day, '%Y-%m-%d') AS day"


def _band(score: str) -> str:
    return f"CASE WHEN {score} > 0.7 THEN 'HIGH' WHEN {score} > 0.4 THEN 'MODERATE' ELSE 'LOW' END"


RULE = "(CASE WHEN cum >= 20 THEN 1.0 ELSE 0.0 END)"
TWO = f"coalesce(CAST(0.33 AS DOUBLE) * {RULE} + CAST(0.67 AS DOUBLE) * p1, {RULE})"
LOCAL = (
    f"greatest(0, least(1, CAST(0.33 AS DOUBLE) * {RULE} + CAST(0.67 AS DOUBLE) * "
    "(1 / (1 + pow(CAST(2.71828 AS DOUBLE), -2 * ((pred * 72 - 10) / 20))))))"
)
RULE_ONLY = "(CASE WHEN cum >= 20 THEN 1 ELSE least(CAST(0.4 AS DOUBLE), cum / 40) END)"


def _scored(name: str, score: str) -> str:
    return sql(
        f"SELECT county, {DAY}, {d('score', 'score')}, {_band('score')} AS level FROM (SELECT *, {score} AS score FROM signals)",
        "readings",
        signals=SIGNALS,
    )


@query("score_three_signal", _scored("three", f"CAST(0.2 AS DOUBLE) * {RULE} + CAST(0.4 AS DOUBLE) * coalesce(p1, 0) + CAST(0.4 AS DOUBLE) * p2"))
def three_signal(t):
    boosted = F.coalesce("p1", F.lit(0.0))
    rows = signals(t).withColumn("score", risk.three_signal(F.col("cum"), boosted, F.col("p2")))
    return rows.select("county", "day", "score", risk.band(F.col("score")).alias("level"))


@query("score_two_signal", _scored("two", TWO))
def two_signal(t):
    rows = signals(t).withColumn("score", risk.two_signal(F.col("cum"), F.col("p1")))
    return rows.select("county", "day", "score", risk.band(F.col("score")).alias("level"))


@query(
    "score_normalise",
    sql(
        f"""SELECT reading_id, {d('''CASE reading_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL
        ELSE least(1, greatest(0, precipitation)) END''', "probability")} FROM readings""",
        "readings",
    ),
)
def normalise(t):
    k = F.col("reading_id") % 6
    raw = (
        F.when(k == 0, F.array(F.lit("1.7")))
        .when(k == 1, F.array(F.lit("-0.2")))
        .when(k == 2, F.array(F.lit("NaN")))
        .when(k == 3, F.array(F.lit("x")))
        .when(k == 4, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("precipitation").cast("string")))
    )
    return t.readings().select("reading_id", risk.normalise(raw).alias("probability"))


@query(
    "score_local_model",
    sql(
        f"SELECT county, {DAY}, {d(LOCAL, 'score')} FROM (SELECT *, cum / 72 AS pred FROM signals)",
        "readings",
        signals=SIGNALS,
    ),
)
def local_model(t):
    score = risk.local_model(F.col("cum") / 72, F.col("cum"))
    return signals(t).select("county", "day", score.alias("score"))


@query(
    "score_rule",
    sql(f"SELECT county, {DAY}, {d(RULE_ONLY, 'score')}, {i('32', 'onset_doy_estimate')} FROM signals", "readings", signals=SIGNALS),
)
def rule(t):
    doy = F.dayofyear(F.lit(SCORED_ON).cast("date"))
    return signals(t).select("county", "day", risk.rule_only(F.col("cum")).alias("score"), doy.alias("onset_doy_estimate"))


@query(
    "score_alert_level",
    sql(
        f"""SELECT county, {DAY}, CASE WHEN cum >= 20 THEN 'WATCH' ELSE {_band(TWO)} END AS level,
        CASE WHEN {_band(TWO)} = 'HIGH' AND cum >= 30 THEN 'WATCH' ELSE {_band(TWO)} END AS served_level FROM signals""",
        "readings",
        signals=SIGNALS,
    ),
)
def alert_level(t):
    score = risk.two_signal(F.col("cum"), F.col("p1"))
    return signals(t).select(
        "county",
        "day",
        risk.alert_level(score, F.col("cum") >= 20).alias("level"),
        risk.served_alert_level(risk.band(score), F.col("cum") >= 30).alias("served_level"),
    )


LATEST = "SELECT county, arg_max(cum, day) AS cum, arg_max(p2, day) AS p2 FROM signals GROUP BY county"


@query(
    "score_source_preference",
    sql(
        f"""SELECT county, {d("cum", "cum_72hr_mm")},
        CASE WHEN served THEN 'api' WHEN pred IS NOT NULL THEN 'local_model' ELSE 'rule' END AS source,
        {d(f"CASE WHEN served THEN p2 WHEN pred IS NOT NULL THEN {LOCAL} ELSE {RULE_ONLY} END", "onset_probability")},
        CASE WHEN served THEN CASE WHEN {_band("p2")} = 'HIGH' AND cum >= 20 THEN 'WATCH' ELSE {_band("p2")} END
             WHEN cum >= 20 THEN 'WATCH'
             WHEN pred IS NOT NULL THEN {_band(LOCAL)} ELSE {_band(RULE_ONLY)} END AS alert_level
        FROM (SELECT *, length(county) % 3 = 0 AS served, CASE WHEN length(county) % 2 = 0 THEN cum / 72 END AS pred FROM latest)""",
        "readings",
        signals=SIGNALS,
        latest=LATEST,
    ),
)
def source_preference(t):
    latest = latest_per(signals(t), ["county"], ["day"]).withColumnRenamed("cum", "cum_72hr_mm")
    letters = F.length("county")
    predictions = latest.filter(letters % 2 == 0).select("county", (F.col("cum_72hr_mm") / 72).alias("prediction"))
    served = latest.filter(letters % 3 == 0).select(
        "county",
        F.col("p2").alias("onset_risk_score"),
        risk.band(F.col("p2")).alias("onset_risk"),
        (F.col("cum_72hr_mm") >= 20).alias("onset_flag"),
    )
    return serving.scored_snapshot(latest.select("county", "cum_72hr_mm"), predictions, served)


def _risk_map(t):
    return serving.risk_map(common.counties(t), common.live(t), common.scores(t))


MAP_SQL = f"""SELECT county, lat, lon, cum, coalesce(onset_flag, false) AS onset_flag, {TWO} AS score, p1, alert_timestamp
  FROM (SELECT *, coalesce(cum_72hr_mm, 0) AS cum, ml_probability AS p1
        FROM counties LEFT JOIN live USING (county) LEFT JOIN scores USING (county))"""
MAP_COLUMNS = (
    f"county, {d('lat', 'lat')}, {d('lon', 'lon')}, {d('cum', 'cum_72hr_mm')}, onset_flag, {d('score', 'onset_risk_score')}, "
    f"{_band('score')} AS onset_risk, {d('p1', 'ml_probability')}, {ts('alert_timestamp', 'alert_timestamp')}"
)


def _map_query(where: str = "") -> str:
    return sql(f"SELECT {MAP_COLUMNS} FROM risk_map {where}", "readings", "counties", **common.SERVING, risk_map=MAP_SQL)


@query("serve_risk_map", _map_query())
def serve_risk_map(t):
    return _risk_map(t)


@query("serve_county_detail", _map_query("WHERE county = 'Kisumu'"))
def serve_county_detail(t):
    return serving.county_detail(_risk_map(t), "Kisumu")


@query("filt_active_alerts", _map_query("WHERE cum > 0 OR score > 0.4"))
def active_alerts(t):
    return filters.active_alerts(_risk_map(t))


@query(
    "serve_map_envelope",
    sql(
        f"""SELECT 'FeatureCollection' AS type, {i("count(*)", "features")}, {i("count(alert_timestamp)", "speed_layer_docs")},
        count(p1) > 0 AS ml_layer_active FROM risk_map""",
        "readings",
        "counties",
        **common.SERVING,
        risk_map=MAP_SQL,
    ),
)
def map_envelope(t):
    text = serving.feature_collection(_risk_map(t), F.lit(SCORED_ON), "v1", common.counties(t))

    def at(path: str):
        return F.get_json_object("geojson", path)

    features = F.json_array_length(at("$.features"))
    return text.select(
        at("$.type").alias("type"),
        features.alias("features"),
        at("$.metadata.speed_layer_docs").cast("bigint").alias("speed_layer_docs"),
        at("$.metadata.ml_layer_active").cast("boolean").alias("ml_layer_active"),
    )


@query(
    "serve_point_colour",
    sql(
        f"SELECT id1, id2, {d('temperature_c', 'risk')}, CASE WHEN temperature_c > 25 THEN 'red' ELSE 'blue' END AS colour FROM climate",
        "climate",
    ),
)
def point_colour(t):
    c = F.col("temperature_c")
    return t.climate().select("id1", "id2", c.alias("risk"), risk.point_colour(c).alias("colour"))
