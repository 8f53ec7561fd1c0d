"""Summaries: means, profiles, error metrics, calendars and climatologies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from pluvia.operators.filters import trailing_days
from pluvia.operators.ordered import ROWS_PER_TASK, quantiles


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def historical_trend(
    history: DataFrame, now: str, days: int = 90, county: str | None = None
) -> DataFrame:
    """Per day and county: mean total and number of onsets in the trailing days."""
    if not 1 <= days <= 365:
        raise ValueError("days must be between 1 and 365")
    rows = trailing_days(history, "observation_date", now, days)
    if county is not None:
        rows = rows.filter(F.col("county") == county)
    return (
        rows.groupBy(F.to_date("observation_date").alias("day"), "county")
        .agg(
            F.coalesce(F.avg("cum_72hr_mm"), F.lit(0.0)).alias("avg_cum_72hr_mm"),
            F.coalesce(F.sum(F.col("onset_flag").cast("int")), F.lit(0)).alias("onset_count"),
        )
        .orderBy("day", "county")
    )


def velocity_report(rows: DataFrame, variables: int, hours: int = 168) -> DataFrame:
    """Counties polled, rain range and the number of values one poll brings."""
    counties = F.count_distinct("county")
    return rows.agg(
        counties.alias("counties"),
        F.min("precipitation").alias("min_precipitation"),
        F.max("precipitation").alias("max_precipitation"),
        (counties * variables * hours).alias("records"),
    )


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and infinite counts of every column in one pass."""
    types = {f.name: f.dataType for f in df.schema}

    def profile(name: str) -> Column:
        c = F.col(name)
        fractional = isinstance(types[name], (T.DoubleType, T.FloatType))
        nan = F.count_if(F.isnan(c)) if fractional else F.lit(0)
        infinite = F.count_if(F.abs(c) == float("inf")) if fractional else F.lit(0)
        missing = F.count_if(c.isNull()) + nan
        cells = F.count(F.lit(1))
        return F.struct(
            F.lit(name).alias("column"),
            missing.cast("bigint").alias("missing"),
            F.try_divide(missing * 100.0, cells).alias("missing_pct"),
            infinite.cast("bigint").alias("infinite"),
            cells.alias("cells"),
        )

    return df.agg(F.array(*[profile(c) for c in columns]).alias("p")).select(F.inline("p"))


def describe(
    df: DataFrame, columns: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column."""
    def plain(c: str) -> Column:
        x = F.col(c).cast("double")
        named = {"count": F.count(x), "mean": F.avg(x), "std": F.stddev(x), "min": F.min(x), "max": F.max(x)}
        return F.struct(F.lit(c).alias("column"), *[f.alias(n) for n, f in named.items()])

    # One wide aggregate for all columns; only the quartiles need a row per value.
    stats = df.agg(F.array(*[plain(c) for c in columns]).alias("s")).select(F.inline("s"))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = df.select(F.inline(pairs))
    quartiles = quantiles(
        long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, rows_per_task=rows_per_task
    )
    return stats.join(quartiles, "column", "left")


def latency_summary(
    samples: DataFrame, key: str, value: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Mean and nearest-rank 99th percentile per group."""
    return quantiles(
        samples,
        [key],
        value,
        {"peak_latency_ms": 0.99},
        nearest_rank=True,
        rows_per_task=rows_per_task,
        count="scale",
        mean="avg_latency_ms",
    )


def latency_summary_approx(samples: DataFrame, key: str, value: str) -> DataFrame:
    """The one-pass form with an approximate percentile."""
    return samples.groupBy(key).agg(
        F.count(value).alias("scale"),
        F.avg(value).alias("avg_latency_ms"),
        F.percentile_approx(value, 0.99, 10_000).alias("peak_latency_ms"),
    )


def error_metrics(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAE, RMSE and R2 of yhat against y."""
    error = F.col("y") - F.col("yhat")
    spread = F.var_pop("y") * F.count("y")
    return pairs.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the overall minimum and maximum (last bin closed)."""
    limits = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("s")).scalar()
    rows = df.filter(F.col(value).isNotNull()).select(value, limits.alias("_s"))
    share = F.try_divide(F.col(value) - F.col("_s.lo"), F.col("_s.hi") - F.col("_s.lo"))
    place = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    return (
        rows.groupBy(place.alias("bin"), "_s")
        .agg(F.count(F.lit(1)).alias("count"))
        .select("bin", (F.col("_s.lo") + F.col("bin") * width).alias("bin_start"), "count")
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("alert_level") == "WATCH").alias("watch_counties"),
    )


def daily_mean(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    return df.groupBy(*keys, F.to_date(time).alias("day")).agg(F.avg(value).alias("mean"))


def diurnal_cycle(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Swing of the hourly means and the (earliest) hour of the peak."""
    hours = df.groupBy(*keys, F.hour(time).alias("hour")).agg(F.avg(value).alias("mean"))
    return hours.groupBy(*keys).agg(
        (F.max("mean") - F.min("mean")).alias("amplitude"),
        F.max_by("hour", F.struct("mean", -F.col("hour"))).alias("peak_hour"),
    )


def spatial_extent(grid: DataFrame, time: str) -> DataFrame:
    """Coordinate limits, number of times and mean rows per time."""
    times = grid.groupBy(time).agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))],
    )
    return times.agg(
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in ("lat", "lon")],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in ("lat", "lon")],
        F.count(F.lit(1)).alias("times"),
        F.avg("rows").alias("rows_per_time"),
    )


def cell_means(grid: DataFrame, value: str, degrees: float = 2.0) -> DataFrame:
    """Mean per square cell: the data of a heat map."""
    return grid.groupBy(
        F.floor(F.col("lat") / degrees).alias("lat_cell"), F.floor(F.col("lon") / degrees).alias("lon_cell")
    ).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("rows"))


def monthly(df: DataFrame, time: str, value: str) -> DataFrame:
    return df.groupBy("county", F.year(time).alias("year"), F.month(time).alias("month")).agg(
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.count(value).alias("rows"),
    )


def onset_dates(history: DataFrame) -> DataFrame:
    """First flagged day of each county and year, with its day of year."""
    return (
        history.filter("onset_flag")
        .groupBy("county", F.year("observation_date").alias("year"))
        .agg(F.to_date(F.min("observation_date")).alias("onset_date"))
        .withColumn("onset_doy", F.dayofyear("onset_date"))
    )


def onset_climatology(onsets: DataFrame, base: tuple[int, int]) -> DataFrame:
    """Mean onset day per county and decade, against the county's base-period mean.

    ``shift_days`` compares the years after the base period with it. The input has one
    row per county and year.
    """
    county = Window.partitionBy("county")
    in_base = F.when(F.col("year").between(*base), F.col("onset_doy"))
    later = F.when(F.col("year") > base[1], F.col("onset_doy"))
    return (
        onsets.withColumns(
            {
                "base_mean_doy": F.avg(in_base).over(county),
                "later_mean_doy": F.avg(later).over(county),
                "decade": F.floor(F.col("year") / 10) * 10,
            }
        )
        .groupBy("county", "decade")
        .agg(
            F.avg("onset_doy").alias("mean_doy"),
            F.first("base_mean_doy").alias("base_mean_doy"),
            F.first(F.col("later_mean_doy") - F.col("base_mean_doy")).alias("shift_days"),
        )
    )
