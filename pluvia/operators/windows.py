"""Lags, rolling means, latest rows and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.functions.weather import region_code, season_flags
from pluvia.operators.filters import select_existing
from pluvia.operators.joins import join_checked
from pluvia.operators.ordered import ROWS_PER_TASK, over_rows, running
from pluvia.schemas import FEATURES

CLIMATE_ORDER = ("date", "id1", "id2", "id3", "id4", "temperature_c")
# Row lags of the model features (named after six-hourly data).
ROW_LAGS = {"temp_lag_6h": 1, "temp_lag_24h": 4}


def row_lags(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    lags: dict[str, int] = ROW_LAGS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Values a number of rows earlier in the same series."""
    return over_rows(
        df,
        keys,
        order,
        max(lags.values()),
        lambda w: [{name: F.lag(value, n).over(w) for name, n in lags.items()}],
        rows_per_task=rows_per_task,
    )


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int,
    name: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Mean of the current and the ``rows - 1`` rows before it."""
    return over_rows(
        df,
        keys,
        order,
        rows - 1,
        lambda w: [{name: F.avg(value).over(w.rowsBetween(-(rows - 1), 0))}],
        rows_per_task=rows_per_task,
    )


def _onset_month(df: DataFrame, warm_above: float) -> DataFrame:
    return df.withColumn("onset", F.when(F.col("temperature_c") > warm_above, F.month("date")))


def onset_month_lag(
    climate: DataFrame, warm_above: float = 25.0, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Month of a warm row, and the same twelve rows earlier at the location."""
    marked = _onset_month(climate, warm_above)
    return row_lags(
        marked, ["lat", "lon"], CLIMATE_ORDER, "onset", {"onset_month_lag": 12}, rows_per_task
    )


def climate_features(
    climate: DataFrame, warm_above: float = 25.0, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The model feature table; rolling mean and lag share one window pass."""
    windowed = over_rows(
        _onset_month(climate, warm_above),
        ["lat", "lon"],
        CLIMATE_ORDER,
        12,
        lambda w: [
            {
                "temp_12mo_rolling": F.avg("temperature_c").over(w.rowsBetween(-11, 0)),
                "onset_month_lag": F.lag("onset", 12).over(w),
            }
        ],
        rows_per_task=rows_per_task,
    )
    month = F.month("date")
    columns = {"year": F.year("date"), "month": month, "region_encoded": region_code(F.col("lat"))}
    return select_existing(windowed.withColumns({**columns, **season_flags(month)}), FEATURES)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key; combined map-side, so a busy key is one row per task."""
    values = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def category_codes(df: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each distinct value with its alphabetical rank from zero: the shared code table."""
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    keyed = distinct.withColumn("_all", F.lit(0))
    return running(keyed, ["_all"], [column], name="code", rows_per_task=rows_per_task).drop("_all")


def with_category_code(df: DataFrame, codes: DataFrame, column: str, name: str) -> DataFrame:
    """Attach codes; an unknown value gets zero."""
    joined = join_checked(df, codes.withColumnRenamed("code", name), [column], "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(0)))


def onset_anomaly(onsets: DataFrame, county: str | None = None) -> DataFrame:
    """Onset day minus the mean over the rows shown: all, or those of one county."""
    shown = onsets if county is None else onsets.filter(F.col("county") == county)
    mean = shown.agg(F.avg("onset_doy")).scalar()
    return shown.withColumn("anomaly", F.col("onset_doy") - mean)


def onset_anomaly_by_county(onsets: DataFrame) -> DataFrame:
    """The per-county form for all counties at once (one row per county and year)."""
    mean = F.avg("onset_doy").over(Window.partitionBy("county"))
    return onsets.withColumn("anomaly", F.col("onset_doy") - mean)
