"""Summaries and the Count-Min sketch."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.functions.weather import region_code
from pluvia.operators import aggregates as a
from pluvia.operators.joins import join_checked
from pluvia.operators.sketch import Sketch, builtin_cells, builtin_sketch
from pluvia.plans import common
from pluvia.plans.projections import REGION_CODE_SQL
from pluvia.plans.registry import d, day, i, query, ts
from pluvia.plans.tables import HISTORY_NOW, sql
from pluvia.schemas import COUNTY_NAMES, county_dim
from pluvia.sources.payloads import daily_rows, hourly_rows


@query(
    "agg_avg_by_region",
    sql(f"SELECT {i(REGION_CODE_SQL, 'region_encoded')}, {d('avg(temperature_c)', 'avg_temperature_c')} FROM climate GROUP BY 1", "climate"),
)
def avg_by_region(t):
    rows = t.climate().withColumn("region_encoded", region_code(F.col("lat")))
    return a.mean_by(rows, ["region_encoded"], "temperature_c", "avg_temperature_c")


@query(
    "agg_avg_by_month",
    sql(f"SELECT {i('month(date)', 'month')}, {d('avg(temperature_c)', 'avg_temperature_c')} FROM climate GROUP BY 1", "climate"),
)
def avg_by_month(t):
    rows = t.climate().withColumn("month", F.month("date"))
    return a.mean_by(rows, ["month"], "temperature_c", "avg_temperature_c")


@query(
    "agg_historical_trend",
    sql(
        f"""SELECT {day("CAST(observation_date AS DATE)", "day")}, county, {d("avg(cum_72hr_mm)", "avg_cum_72hr_mm")},
        {i("sum(CAST(onset_flag AS INT))", "onset_count")} FROM history
        WHERE CAST(observation_date AS DATE) >= DATE '2001-08-01' - 90 GROUP BY CAST(observation_date AS DATE), county""",
        "history",
    ),
)
def historical_trend(t):
    return a.historical_trend(t.history(), HISTORY_NOW, 90)


@query("agg_distinct_coords", sql(f"SELECT DISTINCT {d('lat', 'lat')}, {d('lon', 'lon')} FROM climate", "climate"))
def distinct_coords(t):
    return t.climate().select("lat", "lon").distinct()


@query(
    "agg_velocity_report",
    sql(
        f"""SELECT {i("count(DISTINCT county)", "counties")}, {d("min(precipitation)", "min_precipitation")},
        {d("max(precipitation)", "max_precipitation")}, {i("count(DISTINCT county) * 5 * 168", "records")} FROM hourly""",
        "readings",
        hourly=common.HOURLY,
    ),
)
def velocity(t):
    return a.velocity_report(hourly_rows(common.week_payloads(t)), variables=5)


GAPPY_SQL = """SELECT CASE WHEN reading_id % 50 = 0 THEN CAST('NaN' AS DOUBLE) WHEN reading_id % 77 = 0 THEN CAST('Infinity' AS DOUBLE)
  ELSE precipitation END AS precipitation, CASE WHEN reading_id % 13 <> 0 THEN humidity END AS humidity, county FROM readings"""


def _profile_sql(name: str, fractional: bool) -> str:
    nan = f"count(*) FILTER (isnan({name}))" if fractional else "0"
    inf = f"count(*) FILTER (isinf({name}))" if fractional else "0"
    missing = f"count(*) FILTER ({name} IS NULL) + {nan}"
    return (
        f"SELECT '{name}' AS column, {i(missing, 'missing')}, {d(f'({missing}) * 100 / count(*)', 'missing_pct')}, "
        f"{i(inf, 'infinite')}, {i('count(*)', 'cells')} FROM gappy"
    )


@query(
    "agg_missing_profile",
    sql(
        " UNION ALL ".join(_profile_sql(n, n == "precipitation") for n in ("precipitation", "humidity", "county")).replace(
            "AS column", 'AS "column"'
        ),
        "readings",
        gappy=GAPPY_SQL,
    ),
)
def missing_profile(t):
    k = F.col("reading_id")
    gappy = t.readings().withColumns(
        {
            "precipitation": F.when(k % 50 == 0, float("nan"))
            .when(k % 77 == 0, float("inf"))
            .otherwise(F.col("precipitation")),
            "humidity": F.when(k % 13 != 0, F.col("humidity")),
        }
    )
    return a.missing_profile(gappy, ["precipitation", "humidity", "county"])


def _describe_sql(name: str) -> str:
    return (
        f"SELECT '{name}' AS \"column\", {i(f'count({name})', 'count')}, {d(f'avg({name})', 'mean')}, "
        f"{d(f'stddev_samp({name})', 'std')}, {d(f'min({name})', 'min')}, {d(f'quantile_cont({name}, 0.25)', 'q25')}, "
        f"{d(f'quantile_cont({name}, 0.5)', 'q50')}, {d(f'quantile_cont({name}, 0.75)', 'q75')}, {d(f'max({name})', 'max')} FROM readings"
    )


DESCRIBED = ("precipitation", "temperature", "soil_moisture")
DESCRIBE_SQL = sql(" UNION ALL ".join(_describe_sql(n) for n in DESCRIBED), "readings")


@query("agg_describe", DESCRIBE_SQL)
def describe(t):
    return a.describe(t.readings(), DESCRIBED)


@query("agg_describe_split", DESCRIBE_SQL)
def describe_split(t):
    """The same through the range-split path that large groups take."""
    return a.describe(t.readings(), DESCRIBED, rows_per_task=2000)


LATENCY_SQL = f"""SELECT event_type, {i("any_value(n)", "scale")}, {d("avg(value)", "avg_latency_ms")},
  {d("max(value) FILTER (k = least(floor(CAST(0.99 AS DOUBLE) * n), n - 1) + 1)", "peak_latency_ms")}
FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS k,
      count(*) OVER (PARTITION BY event_type) AS n FROM events) GROUP BY event_type"""


@query("agg_latency_p99", LATENCY_SQL)
def latency(t):
    return a.latency_summary(t.raw("events"), "event_type", "value")


@query(
    "agg_error_metrics",
    sql(
        f"""SELECT county, {d("avg(abs(y - yhat))", "mae")}, {d("sqrt(avg((y - yhat) * (y - yhat)))", "rmse")},
        {d("1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y))", "r2")} FROM pairs GROUP BY county""",
        "readings",
        hourly=common.HOURLY,
        pairs=common.PAIRS,
    ),
)
def error_metrics(t):
    return a.error_metrics(common.pairs(t), ["county"])


@query(
    "agg_residual_hist",
    sql(
        f"""SELECT {i("least(floor((x - lo) / (hi - lo) * 30), 29)", "bin")},
        {d("any_value(lo) + least(floor((x - lo) / (hi - lo) * 30), 29) * (any_value(hi) - any_value(lo)) / 30", "bin_start")}, {i("count(*)", "count")}
        FROM (SELECT precipitation AS x, min(precipitation) OVER () AS lo, max(precipitation) OVER () AS hi FROM residuals)
        GROUP BY least(floor((x - lo) / (hi - lo) * 30), 29)""",
        "readings",
        residuals="SELECT precipitation - avg(precipitation) OVER (PARTITION BY county) AS precipitation FROM readings",
    ),
)
def residual_hist(t):
    rows = t.readings()
    means = rows.groupBy("county").agg(F.avg("precipitation").alias("m"))
    residuals = join_checked(rows, means, ["county"]).select(
        (F.col("precipitation") - F.col("m")).alias("residual")
    )
    return a.histogram(residuals, "residual", 30)


@query(
    "agg_alert_counts",
    sql(
        f"""SELECT {i("count(*)", "alerts")}, {i("count(*) FILTER (onset_flag)", "watch_counties")} FROM windows_72h""",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def alert_counts(t):
    level = F.when(F.col("onset_flag"), "WATCH").otherwise("LOW")
    return a.alert_counts(common.windows_72h(t).withColumn("alert_level", level))


@query(
    "agg_daily_mean",
    sql(
        f"SELECT county, {day('CAST(event_time AS DATE)', 'day')}, {d('avg(temperature)', 'mean')} FROM readings GROUP BY county, CAST(event_time AS DATE)",
        "readings",
    ),
)
def daily_mean(t):
    return a.daily_mean(t.readings(), ["county"], "event_time", "temperature")


@query(
    "agg_diurnal_cycle",
    sql(
        f"""SELECT county, {d("max(m) - min(m)", "amplitude")}, {i("max(h) FILTER (k = 1)", "peak_hour")}
        FROM (SELECT county, h, m, row_number() OVER (PARTITION BY county ORDER BY m DESC, h) AS k FROM
          (SELECT county, hour(event_time) AS h, avg(temperature) AS m FROM readings GROUP BY ALL)) GROUP BY county""",
        "readings",
    ),
)
def diurnal(t):
    return a.diurnal_cycle(t.readings(), ["county"], "event_time", "temperature")


@query(
    "agg_spatial_extent",
    sql(
        f"""SELECT {d("min(lat)", "min_lat")}, {d("max(lat)", "max_lat")}, {d("min(lon)", "min_lon")}, {d("max(lon)", "max_lon")},
        {i("count(DISTINCT date)", "times")}, {d("count(*) / count(DISTINCT date)", "rows_per_time")} FROM climate""",
        "climate",
    ),
)
def spatial_extent(t):
    return a.spatial_extent(t.climate(), "date")


@query(
    "agg_spatial_cells",
    sql(
        f"""SELECT {i("floor(lat / 2)", "lat_cell")}, {i("floor(lon / 2)", "lon_cell")}, {d("avg(temperature_c)", "mean")},
        {i("count(*)", "rows")} FROM climate GROUP BY floor(lat / 2), floor(lon / 2)""",
        "climate",
    ),
)
def spatial_cells(t):
    return a.cell_means(t.climate(), "temperature_c", 2.0)


@query(
    "agg_forecast_total",
    sql(
        f"""SELECT county, {i("CAST(floor((day - DATE '1970-01-01') / 7) AS BIGINT)", "payload_id")}, {d("sum(rain)", "forecast_mm")}
        FROM days GROUP BY ALL""",
        "readings",
        days=common.DAILY,
    ),
)
def forecast_total(t):
    return daily_rows(common.daily_payloads(t)).groupBy("county", "payload_id").agg(
        F.sum("precipitation_mm").alias("forecast_mm")
    )


@query(
    "agg_monthly",
    sql(
        f"""SELECT county, {i("year(observation_date)", "year")}, {i("month(observation_date)", "month")}, {d("sum(cum_72hr_mm)", "total")},
        {d("avg(cum_72hr_mm)", "mean")}, {d("min(cum_72hr_mm)", "lowest")}, {d("max(cum_72hr_mm)", "highest")}, {i("count(*)", "rows")}
        FROM history GROUP BY county, year(observation_date), month(observation_date)""",
        "history",
    ),
)
def monthly(t):
    return a.monthly(t.history(), "observation_date", "cum_72hr_mm")


ONSET_DATES = """SELECT county, year(observation_date) AS year, min(CAST(observation_date AS DATE)) AS onset_date,
  dayofyear(min(observation_date)) AS onset_doy FROM history WHERE onset_flag GROUP BY county, year(observation_date)"""


@query(
    "agg_onset_dates",
    sql(
        f"SELECT county, {i('year', 'year')}, {day('onset_date', 'onset_date')}, {i('onset_doy', 'onset_doy')} FROM onsets",
        "history",
        onsets=ONSET_DATES,
    ),
)
def onset_dates(t):
    return a.onset_dates(t.history())


@query(
    "agg_onset_climatology",
    sql(
        f"""SELECT o.county, {i("year // 10 * 10", "decade")}, {d("avg(onset_doy)", "mean_doy")}, {d("any_value(b)", "base_mean_doy")},
        {d("any_value(l - b)", "shift_days")}
        FROM onsets o JOIN (SELECT county, avg(onset_doy) FILTER (year BETWEEN 1995 AND 1998) AS b,
          avg(onset_doy) FILTER (year > 1998) AS l FROM onsets GROUP BY county) s ON o.county = s.county
        GROUP BY o.county, year // 10 * 10""",
        "history",
        onsets=ONSET_DATES,
    ),
)
def climatology(t):
    return a.onset_climatology(a.onset_dates(t.history()), (1995, 1998))


# The sketch. County keys barely collide at the default width; user keys on a narrow one do.
DEFAULT, NARROW = Sketch(), Sketch(width=60)


def _cells_sql(sketch: Sketch, keys: str) -> str:
    seeds = ", ".join(f"({r}, '{s:08X}')" for r, s in enumerate(sketch.row_seeds))
    return (
        "SELECT key, n, row_id, CAST(CAST('0x' || substr(md5(unhex(seed) || encode(key)), 1, 16) AS UBIGINT) "
        f"% {sketch.width} AS BIGINT) AS col_id FROM {keys}, (VALUES {seeds}) AS s(row_id, seed)"
    )


def _sketch_ctes(sketch: Sketch, counts: str) -> dict[str, str]:
    return {
        "counts": counts,
        "hashed": _cells_sql(sketch, "counts"),
        "cells": "SELECT row_id, col_id, sum(n) AS cnt FROM hashed GROUP BY ALL",
        "estimates": "SELECT key, any_value(n) AS n, min(cnt) AS estimate FROM hashed JOIN cells USING (row_id, col_id) GROUP BY key",
    }


COUNTY_COUNTS = "SELECT county AS key, count(*) AS n FROM readings GROUP BY 1"
USER_COUNTS = "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1"


def _users(t):
    return t.raw("events").select(F.col("user_id").cast("string").alias("user"))


@query(
    "cms_build",
    sql(f"SELECT {i('row_id', 'row_id')}, {i('col_id', 'col_id')}, {i('cnt', 'cnt')} FROM cells", "readings", **_sketch_ctes(DEFAULT, COUNTY_COUNTS)),
)
def cms_build(t):
    return DEFAULT.build(t.readings(), "county")


@query("cms_query", sql(f"SELECT key, {i('estimate', 'estimate')} FROM estimates", **_sketch_ctes(NARROW, USER_COUNTS)))
def cms_query(t):
    return NARROW.query(NARROW.build(_users(t), "user"), _users(t), "user")


@query(
    "cms_topk",
    sql(
        f"SELECT key, {i('estimate', 'estimate')} FROM estimates ORDER BY estimate DESC, list_position({COUNTY_NAMES!r}, key) LIMIT 5",
        "readings",
        **_sketch_ctes(DEFAULT, COUNTY_COUNTS),
    ),
)
def cms_topk(t):
    cells = DEFAULT.build(t.readings(), "county")
    candidates = county_dim(t.spark).select(F.col("county").alias("key"), "pos")
    return DEFAULT.top_k(cells, candidates, 5).select("key", "estimate")


@query(
    "cms_error_report",
    sql(
        f"""SELECT key, {i("n", "true_count")}, {i("estimate", "estimate")}, {i("estimate - n", "overcount")},
        {d(repr(NARROW.epsilon), "epsilon")}, {d(repr(NARROW.delta), "delta")}, {i("t", "total")},
        estimate - n <= CAST({NARROW.epsilon!r} AS DOUBLE) * t AS within_budget
        FROM estimates, (SELECT sum(n) AS t FROM counts)""",
        **_sketch_ctes(NARROW, USER_COUNTS),
    ),
)
def cms_error_report(t):
    exact = _users(t).groupBy(F.col("user").alias("key")).agg(F.count(F.lit(1)).alias("true_count"))
    return NARROW.error_report(NARROW.build(_users(t), "user"), exact)


@query(
    "cms_builtin",
    sql(
        f"""SELECT {i('sum(n)', 'total')}, {i('count(*)', 'keys')}, {i('sum(n)', 'least_counted')}, {i('sum(n)', 'most_counted')},
        {i('max(n)', 'most_frequent')} FROM (SELECT county, count(*) AS n FROM readings WHERE county IS NOT NULL GROUP BY county)""",
        "readings",
    ),
)
def cms_builtin(t):
    """The built-in sketch of all counties: what it has counted, the least and most that a row of its cells adds up to,
    and its estimate of the most frequent county."""
    keys = t.readings().agg(F.count_distinct("county")).scalar()
    rows = builtin_sketch(t.readings(), "county", 0.0027, 0.993, 42)
    found = builtin_cells(rows).agg(
        F.min("counted").alias("least_counted"), F.max("counted").alias("most_counted"), F.min("busiest").alias("most_frequent")
    )
    return found.select(rows.select("total").scalar().alias("total"), keys.alias("keys"), "*")
