"""Projections, conversions and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.functions import weather as w
from pluvia.operators import filters as f
from pluvia.operators.ml import feature_vector
from pluvia.operators.windows import (
    ROW_LAGS,
    category_codes,
    climate_features,
    row_lags,
    with_category_code,
)
from pluvia.plans import common
from pluvia.plans.registry import d, day, i, query, ts
from pluvia.plans.tables import HISTORY_NOW, sql
from pluvia.session import new_folder
from pluvia.sinks.writers import overwrite_parquet

SERIES = (["county"], ["ds", "reading_id"])
REGION_SQL = "CASE WHEN lat >= -1 THEN {0} WHEN lat >= -5 THEN {1} WHEN lat >= -10 THEN {2} ELSE {3} END"
REGION_NAME_SQL = REGION_SQL.format("'Coastal'", "'Highland'", "'Lake'", "'Arid'")
REGION_CODE_SQL = REGION_SQL.format(0, 1, 2, 3)
SEASON_SQL = (
    "CASE WHEN month(date) IN (3,4,5) THEN 'MAM' WHEN month(date) IN (6,7,8) THEN 'JJA' "
    "WHEN month(date) IN (9,10,11) THEN 'OND' ELSE 'DJF' END"
)
SEASON_FLAGS_SQL = ", ".join(
    i(f"CASE WHEN {SEASON_SQL} = '{s}' THEN 1 ELSE 0 END", f"season_{s}") for s in w.SEASONS
)


@query(
    "proj_units",
    sql(
        f"""SELECT reading_id, {d("c + 273.15", "temp_k")}, {d("c", "temp_c")}, {d("c * 9 / 5 + 32", "temp_f")},
        {d("c * c", "temp_squared")}, {i("floor(c / 10)", "temp_bucket")}, {d("coalesce(kn, 295.15)", "temp_k_or_neutral")}
        FROM (SELECT reading_id, temperature AS c,
              CASE WHEN reading_id % 11 <> 0 THEN temperature + 273.15 END AS kn FROM readings)""",
        "readings",
    ),
)
def units(t):
    c = F.col("temperature")
    gappy = F.when(F.col("reading_id") % 11 != 0, c)
    return t.readings().select(
        "reading_id",
        w.celsius_to_kelvin(c).alias("temp_k"),
        w.kelvin_to_celsius(w.celsius_to_kelvin(c)).alias("temp_c"),
        w.celsius_to_fahrenheit(c).alias("temp_f"),
        F.pow(c, F.lit(2)).alias("temp_squared"),
        w.temperature_bucket(c).alias("temp_bucket"),
        w.celsius_to_kelvin(gappy).alias("temp_k_or_neutral"),
    )


@query(
    "proj_step_hours",
    sql(
        f"""SELECT reading_id,
        {i("floor((epoch(event_time) - epoch(TIMESTAMP '2024-01-01')) / 3600)", "step_hours")}
        FROM readings""",
        "readings",
    ),
)
def step_hours(t):
    step = F.col("event_time") - F.lit("2024-01-01").cast("timestamp")
    return t.readings().select("reading_id", w.step_hours(step).alias("step_hours"))


@query(
    "proj_date_parts",
    sql(
        f"""SELECT reading_id, {day("event_time", "date")}, {i("year(event_time)", "year")},
        {i("month(event_time)", "month")}, {i("hour(event_time)", "hour")}, {i("dayofyear(event_time)", "doy")}
        FROM readings""",
        "readings",
    ),
)
def date_parts(t):
    e = F.col("event_time")
    return t.readings().select(
        "reading_id",
        F.to_date(e).alias("date"),
        F.year(e).alias("year"),
        F.month(e).alias("month"),
        F.hour(e).alias("hour"),
        F.dayofyear(e).alias("doy"),
    )


@query(
    "proj_region_band",
    sql(
        f"SELECT id1, id2, {d('lat', 'lat')}, {REGION_NAME_SQL} AS region, {i(REGION_CODE_SQL, 'region_encoded')} FROM climate",
        "climate",
    ),
)
def region(t):
    lat = F.col("lat")
    return t.climate().select(
        "id1", "id2", "lat", w.region_band(lat).alias("region"), w.region_code(lat).alias("region_encoded")
    )


@query(
    "proj_season_onehot",
    sql(f"SELECT id1, id2, {SEASON_SQL} AS season, {SEASON_FLAGS_SQL} FROM climate", "climate"),
)
def season(t):
    month = F.month("date")
    return t.climate().select(
        "id1",
        "id2",
        w.season(month).alias("season"),
        *[c.alias(n) for n, c in w.season_flags(month).items()],
    )


COUNTY_SQL = (
    "CASE WHEN lat = 1.25 AND lon = 36.75 THEN 'Nairobi' "
    "WHEN lat BETWEEN -4.2 AND -3.8 AND lon BETWEEN 39.4 AND 39.8 THEN 'Mombasa' "
    "WHEN lat BETWEEN 3.0 AND 4.0 AND lon BETWEEN 35.0 AND 36.5 THEN 'Turkana' "
    "ELSE 'Region_' || CAST(lat AS VARCHAR) || '_' || CAST(lon AS VARCHAR) END"
)


@query("proj_county_from_coord", sql(f"SELECT id1, id2, {COUNTY_SQL} AS county FROM climate", "climate"))
def county_names(t):
    return t.climate().select(
        "id1", "id2", w.county_from_coord(F.col("lat"), F.col("lon")).alias("county")
    )


CODES_SQL = "SELECT county, dense_rank() OVER (ORDER BY county) - 1 AS county_cat FROM (SELECT DISTINCT county FROM enriched)"


def _coded(t, df):
    return with_category_code(df, category_codes(t.enriched(), "county"), "county", "county_cat")


@query(
    "proj_category_code",
    sql(
        f"SELECT reading_id, county, {i('county_cat', 'county_cat')} FROM enriched JOIN codes USING (county)",
        "enriched",
        codes=CODES_SQL,
    ),
)
def category_code(t):
    return _coded(t, t.enriched()).select("reading_id", "county", "county_cat")


LAGGED_SQL = """SELECT *, lag(temp_k, 1) OVER (PARTITION BY county ORDER BY ds, reading_id) AS lag1,
  lag(temp_k, 4) OVER (PARTITION BY county ORDER BY ds, reading_id) AS lag4 FROM enriched"""


@query(
    "proj_feature_vector",
    sql(
        f"""SELECT reading_id, {d("y", "y")}, {d("coalesce(CASE WHEN reading_id % 13 <> 0 THEN surface_pressure END, 1013)", "surface_pressure")},
        {d("temp_k", "temp_k")}, {d("coalesce(lag1, 295.15)", "temp_lag_6h")}, {d("coalesce(lag4, 295.15)", "temp_lag_24h")},
        {d("county_cat", "county_cat")}
        FROM lagged JOIN codes USING (county)""",
        "enriched",
        lagged=LAGGED_SQL,
        codes=CODES_SQL,
    ),
)
def vector(t):
    gappy = F.when(F.col("reading_id") % 13 != 0, F.col("surface_pressure"))
    lagged = row_lags(t.enriched(), *SERIES, "temp_k").withColumn("surface_pressure", gappy)
    return feature_vector(_coded(t, lagged)).select(
        "reading_id", "y", "surface_pressure", "temp_k", *ROW_LAGS, "county_cat"
    )


CLIMATE_WINDOW = "PARTITION BY lat, lon ORDER BY date, id1, id2, id3, id4, temperature_c"
FEATURES_SQL = f"""SELECT {d("lat", "lat")}, {d("lon", "lon")}, {i(REGION_CODE_SQL, "region_encoded")},
  {i("year(date)", "year")}, {i("month(date)", "month")}, {SEASON_FLAGS_SQL},
  {d(f"avg(temperature_c) OVER ({CLIMATE_WINDOW} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)", "temp_12mo_rolling")},
  {i(f"lag(CASE WHEN temperature_c > 25 THEN month(date) END, 12) OVER ({CLIMATE_WINDOW})", "onset_month_lag")},
  {d("temperature_c", "temperature_c")} FROM climate"""


@query("proj_feature_select", sql(FEATURES_SQL, "climate"))
def features(t):
    return climate_features(t.climate())


@query(
    "filt_station",
    sql(f"SELECT reading_id, {d('precipitation', 'precipitation')} FROM readings WHERE county = 'Nairobi'", "readings"),
)
def station(t):
    """On a table laid out by county, where the scan opens one folder."""
    return f.by_station(laid_out(t), "Nairobi").select("reading_id", "precipitation")


def laid_out(t):
    """The readings by county, read back; written once a session for each state of the table."""
    files = t.spark.read.format("binaryFile").load(f"{t.folder}/events.parquet")
    state = files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length"))).first()[0]
    key = (t.spark.sparkContext.applicationId, t.folder, state)
    if key not in _layouts:
        path = new_folder(t.spark, "by-county")
        # rebalanced by county: AQE cuts a county that is too large for one task
        overwrite_parquet(t.readings().hint("rebalance", "county"), path, ("county",))
        _layouts[key] = path
    return t.spark.read.schema(t.readings().schema).parquet(_layouts[key])


# Folders by session, table and the state of its files.
_layouts: dict[tuple[str, str, int | None], str] = {}


@query(
    "filt_year_range",
    sql(
        f"""SELECT observation_id, {day("observation_date", "observed")}, {d("cum_72hr_mm", "cum_72hr_mm")}
        FROM history WHERE year(observation_date) BETWEEN 1996 AND 1999""",
        "history",
    ),
)
def year_range(t):
    rows = f.by_years(t.history(), 1996, 1999, "observation_date")
    return rows.select("observation_id", F.to_date("observation_date").alias("observed"), "cum_72hr_mm")


@query(
    "filt_trailing_days",
    sql(
        f"""SELECT observation_id, county FROM history
        WHERE CAST(observation_date AS DATE) >= DATE '2001-08-01' - 90""",
        "history",
    ),
)
def trailing(t):
    return f.trailing_days(t.history(), "observation_date", HISTORY_NOW, 90).select("observation_id", "county")


@query(
    "filt_trailing_days_latest",
    sql(
        "SELECT reading_id, county FROM enriched WHERE ds >= (SELECT max(ds) FROM enriched) - INTERVAL 14 DAY",
        "enriched",
    ),
)
def trailing_latest(t):
    return f.trailing_from_latest(t.enriched(), "ds", 14).select("reading_id", "county")


@query(
    "filt_dropna",
    sql(f"SELECT reading_id, {d('lag4', 'temp_lag_24h')} FROM lagged WHERE lag1 IS NOT NULL AND lag4 IS NOT NULL", "enriched", lagged=LAGGED_SQL),
)
def dropna(t):
    lagged = row_lags(t.enriched(), *SERIES, "temp_k")
    return f.drop_missing(lagged).select("reading_id", "temp_lag_24h")


@query(
    "filt_unexpired",
    sql(
        f"""SELECT county, {ts("alert_timestamp", "alert_timestamp")} FROM live
        WHERE alert_timestamp + INTERVAL 7 DAY > (SELECT max(alert_timestamp) FROM live) + INTERVAL 5 DAY""",
        "readings",
        **common.SERVING,
    ),
)
def unexpired(t):
    live = common.live(t).withColumns(
        {"expires_at": F.col("alert_timestamp") + F.make_dt_interval(F.lit(7)), "ingested_at": F.col("alert_timestamp")}
    )
    now = live.agg(F.max("alert_timestamp")).scalar() + F.make_dt_interval(F.lit(5))
    return f.unexpired(live, now).select("county", "alert_timestamp")
