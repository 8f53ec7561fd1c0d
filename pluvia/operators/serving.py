"""Serving views: the blended risk map, one county, and the source preference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.functions import risk
from pluvia.operators.joins import risk_map_rows, with_model_probability
from pluvia.schemas import county_dim


def risk_map(counties: DataFrame, live: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per county: live rain, model probability (may be null), blended score and band."""
    rows = with_model_probability(risk_map_rows(counties, live), scores)
    score = risk.two_signal(F.col("cum_72hr_mm"), F.col("ml_probability"))
    return rows.withColumn("_score", score).select(
        "county",
        "lat",
        "lon",
        "cum_72hr_mm",
        F.coalesce("onset_flag", F.lit(False)).alias("onset_flag"),
        F.round("_score", 4).alias("onset_risk_score"),
        risk.band(F.col("_score")).alias("onset_risk"),
        F.round("ml_probability", 4).alias("ml_probability"),
        "alert_timestamp",
    )


def county_detail(rows: DataFrame, county: str) -> DataFrame:
    """The risk-map row of one county; empty for an unknown name."""
    return rows.filter(F.col("county") == county)


def features(rows: DataFrame) -> DataFrame:
    """GeoJSON features; a null probability is left out of the text."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    fields = ["county", "cum_72hr_mm", "onset_risk_score", "onset_risk", "alert_timestamp", "ml_probability"]
    feature = F.struct(
        F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*fields).alias("properties")
    )
    return rows.select("county", feature.alias("feature"))


def feature_collection(
    rows: DataFrame, updated: Column, model_version: str, counties: DataFrame | None = None
) -> DataFrame:
    """The whole map as one GeoJSON text.

    One text holds one feature per county, so it is bounded by the dimension ``counties``
    (column ``county``; the built-in one by default): other names have no place on the map.
    """
    dim = county_dim(rows.sparkSession) if counties is None else counties
    known = features(rows.join(dim.select("county"), "county", "semi"))
    live = F.count("feature.properties.alert_timestamp")
    scored = F.count("feature.properties.ml_probability")
    metadata = F.struct(
        updated.alias("last_updated_utc"),
        F.lit(model_version).alias("model_version"),
        (scored > 0).alias("ml_layer_active"),
        live.alias("speed_layer_docs"),
        F.count(F.lit(1)).alias("feature_count"),
    )
    body = F.struct(
        F.lit("FeatureCollection").alias("type"),
        metadata.alias("metadata"),
        F.collect_list("feature").alias("features"),
    )
    return known.agg(F.to_json(body).alias("geojson"))


def scored_snapshot(snapshot: DataFrame, predictions: DataFrame, served: DataFrame) -> DataFrame:
    """The best score per county: served, else local model, else the rule; with its source.

    ``predictions`` (county, prediction) and ``served`` (county, onset_risk_score,
    onset_risk, onset_flag) may lack counties.
    """
    rows = snapshot.join(predictions, "county", "left").join(served, "county", "left")
    total, fired = F.col("cum_72hr_mm"), F.col("cum_72hr_mm") >= risk.ONSET_MM

    def option(score: Column, level: Column, source: str, known: Column) -> Column:
        fields = F.struct(
            score.alias("onset_probability"), level.alias("alert_level"), F.lit(source).alias("source")
        )
        return F.when(known, fields)

    api_level = risk.served_alert_level(F.col("onset_risk"), F.coalesce("onset_flag", F.lit(False)))
    local = risk.local_model(F.col("prediction"), total)
    rule = risk.rule_only(total)
    best = risk.prefer(
        option(F.col("onset_risk_score"), api_level, "api", F.col("onset_risk_score").isNotNull()),
        option(local, risk.alert_level(local, fired), "local_model", F.col("prediction").isNotNull()),
        option(rule, risk.alert_level(rule, fired), "rule", F.lit(True)),
    )
    return rows.withColumn("_best", best).select("county", "_best.*", "cum_72hr_mm")
