"""Grouped summaries of a measured series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.operators.quantiles import exact_quantiles
from loadvane.session import settle

MONTHS = list(range(1, 13))


def profile(
    df: DataFrame, by: dict[str, Column], value: str
) -> DataFrame:
    """Mean, 10th and 90th percentile of ``value`` per key."""
    keyed = df.select(*[c.alias(k) for k, c in by.items()], F.col(value).alias("measured"))
    return exact_quantiles(
        keyed, list(by), "measured", {"p10": 0.1, "p90": 0.9}, extras={"mean": F.avg}
    )


def mean_by(df: DataFrame, by: dict[str, Column], value: str) -> DataFrame:
    return df.groupBy(*[c.alias(k) for k, c in by.items()]).agg(F.avg(value).alias("mean"))


def pivot_hour_month(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Weekday means, one row per hour and one column per month."""
    wide = (
        df.filter(F.weekday(ts) < 5)
        .select(F.hour(ts).alias("hour"), F.month(ts).alias("month"), F.col(value).alias("v"))
        .groupBy("hour")
        .pivot("month", MONTHS)
        .agg(F.avg("v"))
    )
    return wide.select("hour", *[F.col(str(m)).alias(f"m{m:02d}") for m in MONTHS])


def daily_sum_dense(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Sum per day for every day between the first and the last; empty days are 0."""
    sums = df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(value).alias("total"))
    spine = sums.agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("day")
    )
    return spine.join(sums, "day", "left").select("day", F.coalesce("total", F.lit(0.0)).alias("total"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
        ).alias("cell")
    ).select("cell.*")
    moments = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return exact_quantiles(long, ["column"], "v", quartiles, extras=moments).select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width counts over the value's range; the last bin is closed, empty bins are kept.

    The known values are stored as one column, so ``df`` is evaluated once.
    """
    df = settle(df.select(value).filter(F.col(value).isNotNull()), "histogram-values")
    edges = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low = edges.select("low").scalar()
    high = edges.select("high").scalar()
    v = F.col(value)
    placed = F.when(low == high, F.lit(1)).otherwise(F.least(F.width_bucket(v, low, high, F.lit(bins)), F.lit(bins)))
    counted = (
        df.select(placed.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spine = edges.select("low", "high", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("high") - F.col("low")) / bins
    return spine.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + width * (F.col("bin") - 1)).alias("bin_low"),
        (F.col("low") + width * F.col("bin")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def kpis(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean error, mean absolute error and mean absolute percentage error, rounded to 2 places."""
    return metrics.groupBy(*by).agg(
        *[
            F.round(F.avg(f"{what}_{error}") * scale, 2).alias(f"{what}_{name}")
            for what in ("energy", "temp_f")
            for name, error, scale in (("me", "error", 1), ("mae", "error_abs", 1), ("mape", "error_abs_pct", 100))
        ]
    )


def distinct_versions(metrics: DataFrame) -> DataFrame:
    return metrics.select("model_version").distinct()


def station_search(stations: DataFrame, state: str, active_since: str, name_part: str, limit: int) -> DataFrame:
    """Stations of a state still reporting after a date, newest record first, then by name."""
    return (
        stations.filter(
            (F.col("STATE") == state)
            & (F.col("END") > F.lit(active_since).cast("date"))
            & F.col("STATION NAME").contains(name_part)
        )
        .orderBy(F.desc("END"), F.asc("STATION NAME"), F.asc("USAF"), F.asc("WBAN"))
        .limit(limit)
    )
