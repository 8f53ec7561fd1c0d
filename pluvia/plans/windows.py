"""Lags, rolling frames and the batch onset rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.operators import windows as w
from pluvia.operators.filters import newest, sample_by_county, sample_fixed, union_all
from pluvia.operators.onset import onset_by_rows, onset_trailing
from pluvia.operators.ordered import fill_next
from pluvia.plans import common
from pluvia.plans.aggregates import ONSET_DATES
from pluvia.plans.projections import CLIMATE_WINDOW, SERIES
from pluvia.operators.aggregates import onset_dates
from pluvia.plans.registry import d, i, query, ts
from pluvia.plans.tables import sql
from pluvia.schemas import COUNTY_NAMES
from pluvia.session import new_folder
from pluvia.sinks.writers import overwrite_parquet
from pluvia.sources.files import newest_n_files
from pluvia.sources.payloads import forecast_onset, parse_payload, trailing_snapshot
from pluvia.streaming.windows import onset_exact

# Small enough that the test tables take the range-split path.
SPLIT, SPLIT_CLIMATE = 400, 600

LAGS_SQL = sql(
    f"""SELECT reading_id, {d("lag(y, 1) OVER w", "temp_lag_6h")}, {d("lag(y, 4) OVER w", "temp_lag_24h")}
    FROM enriched WINDOW w AS (PARTITION BY county ORDER BY ds, reading_id)""",
    "enriched",
)


@query("win_lag_by_county", LAGS_SQL)
def lag_by_county(t):
    return w.row_lags(t.enriched(), *SERIES, "y").select("reading_id", *w.ROW_LAGS)


@query("win_lag_by_county_split", LAGS_SQL)
def lag_by_county_split(t):
    """The same through the range-split path that large counties take."""
    return w.row_lags(t.enriched(), *SERIES, "y", rows_per_task=SPLIT).select("reading_id", *w.ROW_LAGS)


@query(
    "win_lag_global",
    sql(
        f"""SELECT reading_id, {i("hour(ds)", "hour")}, {i("month(ds)", "month")}, {d("lag(y, 1) OVER w", "temp_lag_6h")},
        {d("lag(y, 4) OVER w", "temp_lag_24h")} FROM enriched WINDOW w AS (PARTITION BY county ORDER BY ds, reading_id)""",
        "enriched",
    ),
)
def lag_single_series(t):
    """The single-site features (hour, month, lags), keyed by location for every site."""
    rows = w.row_lags(t.enriched(), *SERIES, "y")
    return rows.select("reading_id", F.hour("ds").alias("hour"), F.month("ds").alias("month"), *w.ROW_LAGS)


def _rolling_sql(rows: int) -> str:
    frame = f"{CLIMATE_WINDOW} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"
    return sql(
        f"SELECT id1, id2, id3, id4, {d(f'avg(temperature_c) OVER ({frame})', 'rolling')} FROM climate", "climate"
    )


def _rolling(t, rows: int, **options):
    out = w.rolling_mean(t.climate(), ["lat", "lon"], w.CLIMATE_ORDER, "temperature_c", rows, "rolling", **options)
    return out.select("id1", "id2", "id3", "id4", "rolling")


@query("win_rolling_12", _rolling_sql(12))
def rolling_12(t):
    return _rolling(t, 12)


@query("win_rolling_12_split", _rolling_sql(12))
def rolling_12_split(t):
    return _rolling(t, 12, rows_per_task=SPLIT_CLIMATE)


@query("win_rolling_3", _rolling_sql(3))
def rolling_3(t):
    return _rolling(t, 3)


@query(
    "win_onset_month_lag",
    sql(
        f"""SELECT id1, id2, id3, id4, {i("onset", "onset")}, {i(f"lag(onset, 12) OVER ({CLIMATE_WINDOW})", "onset_month_lag")}
        FROM (SELECT *, CASE WHEN temperature_c > 25 THEN month(date) END AS onset FROM climate)""",
        "climate",
    ),
)
def onset_month_lag(t):
    return w.onset_month_lag(t.climate()).select("id1", "id2", "id3", "id4", "onset", "onset_month_lag")


# The stand-in readings never reach 20 mm within 72 rows, hence the lower threshold.
ROWS72_MM = 14.0
ROWS72_SQL = sql(
    f"""SELECT county, {d("round(s / 1e6 + 1e-9, 2)", "cum_72hr_mm")}, true AS onset_flag, {i("k - 72", "window_start")}, {i("k - 1", "window_end")}
    FROM (SELECT county, sum(CAST(round(precipitation * 1000000) AS BIGINT)) OVER f AS s, count(*) FILTER (precipitation = 0) OVER f AS z,
            row_number() OVER (PARTITION BY county ORDER BY event_time, reading_id) AS k
          FROM readings WINDOW f AS (PARTITION BY county ORDER BY event_time, reading_id ROWS BETWEEN 71 PRECEDING AND CURRENT ROW))
    WHERE k >= 72 AND s >= {ROWS72_MM} * 1000000 AND z = 0""",
    "readings",
)


@query("win_onset_rows72", ROWS72_SQL)
def onset_rows72(t):
    return onset_by_rows(t.readings(), ROWS72_MM)


@query("win_onset_rows72_split", ROWS72_SQL)
def onset_rows72_split(t):
    return onset_by_rows(t.readings(), ROWS72_MM, rows_per_task=SPLIT)


@query(
    "win_onset_forecast168",
    sql(
        f"""SELECT county, {i("payload_id", "payload_id")}, CASE WHEN n >= 72 THEN 'ok' ELSE 'insufficient_data' END AS onset_signal,
        {d("CASE WHEN n >= 72 THEN round(s + 1e-9, 2) END", "cum_precipitation_72hr_mm")}, CASE WHEN n >= 72 THEN z > 0 END AS dry_spell_detected,
        CASE WHEN n >= 72 THEN s >= 20 AND z = 0 END AS onset_flag,
        CASE WHEN n >= 72 THEN t0 END AS onset_window_start, CASE WHEN n >= 72 THEN t1 END AS onset_window_end
        FROM (SELECT county, payload_id, any_value(n) AS n, sum(precipitation) FILTER (k <= 72) AS s,
          count(*) FILTER (k > 72 AND k <= 168 AND precipitation = 0) AS z,
          max(strftime(hour, '%Y-%m-%dT%H:%M')) FILTER (k = 1) AS t0, max(strftime(hour, '%Y-%m-%dT%H:%M')) FILTER (k = 72) AS t1
          FROM weeks GROUP BY ALL)""",
        "readings",
        hourly=common.HOURLY,
        weeks=common.WEEK_ROWS,
    ),
)
def onset_forecast168(t):
    return forecast_onset(common.week_payloads(t))


@query(
    "win_onset_exact48",
    sql(
        f"""SELECT county, {ts("ws", "window_start")}, {ts("ws + INTERVAL 72 HOUR", "window_end")}, {d("s", "cum_72hr_mm")}, {i("z", "dry_after")},
        {i("n", "event_count")}, coalesce(s >= 20 AND z = 0, false) AS onset_flag
        FROM (SELECT county, ws, sum(precipitation) FILTER (event_time < ws + INTERVAL 72 HOUR) AS s,
          count(*) FILTER (event_time >= ws + INTERVAL 72 HOUR AND precipitation = 0) AS z,
          CASE WHEN count(*) FILTER (event_time < ws + INTERVAL 72 HOUR) > 0 THEN count(*) FILTER (event_time < ws + INTERVAL 72 HOUR) END AS n
          FROM (SELECT *, time_bucket(INTERVAL '24 hours', event_time, TIMESTAMP '1970-01-01') - to_hours(24 * k) AS ws
                FROM readings, range(5) r(k)) GROUP BY ALL)""",
        "readings",
    ),
)
def onset_exact48(t):
    return onset_exact(t.readings())


@query(
    "win_onset_back48",
    sql(
        f"""SELECT county, {ts("hour", "hour")}, {i("readings", "readings")}, {d("rain", "rain")}, {d("s", "cum_72hr_mm")}, {i("z", "zero_hours_48")}, s >= 10 AND z = 0 AS onset_flag
        FROM (SELECT county, hour, readings, precipitation AS rain,
          sum(precipitation) OVER (PARTITION BY county ORDER BY hour RANGE BETWEEN INTERVAL 71 HOUR PRECEDING AND CURRENT ROW) AS s,
          count(*) FILTER (precipitation = 0) OVER (PARTITION BY county ORDER BY hour RANGE BETWEEN INTERVAL 47 HOUR PRECEDING AND CURRENT ROW) AS z
          FROM hourly)""",
        "readings",
        hourly=common.HOURLY,
    ),
)
def onset_back48(t):
    return onset_trailing(t.readings(), threshold=10.0)


@query(
    "win_trailing_snapshot",
    sql(
        f"""SELECT county, {i("payload_id", "payload_id")}, {d("sum(precipitation) FILTER (k > n - 72)", "cum_72hr_mm")},
        {d("max(temperature) FILTER (k = n)", "temp_c")}, {d("max(temperature) FILTER (k = n - 6)", "temp_lag_6h_c")},
        {d("max(temperature) FILTER (k = n - 24)", "temp_lag_24h_c")},
        {d("CASE WHEN max(pressure) FILTER (k = n) = 0 THEN 1013 ELSE max(pressure) FILTER (k = n) END", "pressure_hpa")}
        FROM weeks GROUP BY ALL""",
        "readings",
        hourly=common.HOURLY,
        weeks=common.WEEK_ROWS,
    ),
)
def snapshot(t):
    """From the JSON texts, through the same parser as live payloads."""
    weeks = common.week_payloads(t)
    texts = weeks.select("county", "payload_id", F.to_json(F.struct("hourly")).alias("payload"))
    return trailing_snapshot(parse_payload(texts, "payload", "hourly"))


BACKFILL_SQL = sql(
    f"""SELECT reading_id, {d("first_value(v IGNORE NULLS) OVER (PARTITION BY county ORDER BY event_time, reading_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)", "humidity")}
    FROM (SELECT *, CASE WHEN humidity < 20 THEN humidity END AS v FROM readings)""",
    "readings",
)


def _gappy(t):
    return t.readings().withColumn("humidity", F.when(F.col("humidity") < 20, F.col("humidity").cast("double")))


@query("win_backfill", BACKFILL_SQL)
def backfill(t):
    filled = fill_next(_gappy(t), ["county"], ["event_time", "reading_id"], ["humidity"])
    return filled.select("reading_id", "humidity")


@query("win_backfill_split", BACKFILL_SQL)
def backfill_split(t):
    filled = fill_next(_gappy(t), ["county"], ["event_time", "reading_id"], ["humidity"], rows_per_task=SPLIT)
    return filled.select("reading_id", "humidity")


@query(
    "win_latest_per_location",
    sql(
        f"""SELECT {d("lat", "lat")}, {d("lon", "lon")}, strftime(date, '%Y-%m-%d') AS date, id1, {d("temperature_c", "temperature_c")}
        FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY date DESC, id1 DESC, id2 DESC, id3 DESC, id4 DESC, temperature_c DESC) AS k FROM climate)
        WHERE k = 1""",
        "climate",
    ),
)
def latest_per_location(t):
    rows = w.latest_per(t.climate(), ["lat", "lon"], w.CLIMATE_ORDER)
    return rows.select("lat", "lon", "date", "id1", "temperature_c")


@query(
    "win_onset_anomaly",
    sql(
        f"""SELECT county, {i("year", "year")}, {i("onset_doy", "onset_doy")},
        {d("onset_doy - avg(onset_doy) OVER (PARTITION BY county)", "anomaly")} FROM onsets""",
        "history",
        onsets=ONSET_DATES,
    ),
)
def onset_anomaly(t):
    rows = w.onset_anomaly_by_county(onset_dates(t.history()))
    return rows.select("county", "year", "onset_doy", "anomaly")


@query(
    "win_onset_anomaly_global",
    sql(
        f"""SELECT county, {i("year", "year")}, {d("onset_doy - avg(onset_doy) OVER ()", "anomaly")} FROM onsets""",
        "history",
        onsets=ONSET_DATES,
    ),
)
def onset_anomaly_global(t):
    return w.onset_anomaly(onset_dates(t.history())).select("county", "year", "anomaly")


@query("sort_series", sql(f"SELECT county, {ts('ds', 'ds')}, reading_id, {d('y', 'y')} FROM enriched", "enriched"))
def sort_series(t):
    return t.enriched().orderBy("county", "ds", "reading_id").select("county", "ds", "reading_id", "y")


@query(
    "limit_latest_alerts",
    sql(
        f"""SELECT county, {ts("window_end", "timestamp")}, {d("cum_72hr_mm", "rolling_72hr_precip")} FROM windows_72h
        ORDER BY window_end DESC, county DESC LIMIT 20""",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def latest_alerts(t):
    rows = newest(common.windows_72h(t), 20, "window_end", "county")
    return rows.select(
        "county", F.col("window_end").alias("timestamp"), F.col("cum_72hr_mm").alias("rolling_72hr_precip")
    )


@query(
    "set_union_files",
    sql(
        f"""SELECT county, {ts("window_start", "window_start")}, {d("cum_72hr_mm", "cum_72hr_mm")} FROM windows_72h
        """,
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def union_files(t):
    """Results of three periods written apart, read back and united."""
    rows = common.windows_72h(t).select("county", "window_start", "cum_72hr_mm")
    first, second = (F.lit(day).cast("timestamp") for day in ("2024-01-16", "2024-01-22"))
    start = F.col("window_start")
    parts = []
    for period in (start < first, (start >= first) & (start < second), start >= second):
        path = new_folder(t.spark, "part")
        overwrite_parquet(rows.filter(period), path)
        parts.append(t.spark.read.schema(rows.schema).parquet(path))
    return union_all(parts)


@query(
    "set_union_newest_files",
    sql(
        f"""SELECT county, {ts("window_start", "window_start")}, {d("cum_72hr_mm", "cum_72hr_mm")} FROM windows_72h
        WHERE window_start >= TIMESTAMP '2024-01-16'""",
        "readings",
        windows_72h=common.WINDOWS_72H,
    ),
)
def union_newest_files(t):
    """Three periods appended to one folder, one file each; the two newest files are read."""
    rows, path = common.windows_72h(t).select("county", "window_start", "cum_72hr_mm"), new_folder(t.spark, "parts")
    first, second = (F.lit(day).cast("timestamp") for day in ("2024-01-16", "2024-01-22"))
    start = F.col("window_start")
    for period in (start < first, (start >= first) & (start < second), start >= second):
        rows.filter(period).coalesce(1).write.mode("append").parquet(path)
    return newest_n_files(rows, path, 2)


@query(
    "sample_rows",
    sql(f"SELECT county, {i('count(*)', 'rows')}, count(*) = count(reading_id) AS is_subset, count(*) > 0 AS share_fits FROM readings GROUP BY county", "readings"),
)
def sample_rows(t):
    """A tenth of each county: every sampled row is a row of the table, and the share is within five
    standard deviations of a tenth."""
    shares = {n: 0.1 for n in COUNTY_NAMES}
    taken = sample_by_county(t.readings(), shares, seed=7).select("reading_id", F.lit(True).alias("taken"))
    known = t.readings().select("reading_id", "county").join(taken, "reading_id", "left")
    strange = taken.join(t.readings().select("reading_id"), "reading_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    n, got = F.count(F.lit(1)), F.count("taken")
    fits = F.abs(got - 0.1 * n) <= 5 * F.sqrt(0.09 * n) + 1
    return known.groupBy("county").agg(n.alias("rows"), fits.alias("share_fits")).select(
        "county", "rows", (strange == 0).alias("is_subset"), "share_fits"
    )


@query(
    "sample_rows_fixed",
    sql(
        f"""SELECT county, reading_id, {d("precipitation", "precipitation")} FROM (SELECT *, row_number() OVER
        (PARTITION BY county ORDER BY md5('7:' || CAST(reading_id AS VARCHAR)), reading_id) AS place FROM readings) WHERE place <= 40""",
        "readings",
    ),
)
def sample_rows_fixed(t):
    """Forty readings of each county by hash."""
    return sample_fixed(t.readings(), "county", "reading_id", 40, seed=7).select("county", "reading_id", "precipitation")
