"""Training features, run log and model store."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadvane import schemas
from loadvane.functions.columns import add_month_flags, add_polynomials, drop_nulls, trim_range
from loadvane.functions.timefn import add_calendar, in_window
from loadvane.operators.metrics import performance_metrics
from loadvane.operators.regression import LinearModel, cross_validate, fit_ols

# The default feature list and the plausible range of hourly demand.
FEATURES = [
    "temp_F", "year", "day_of_year", "hour", "is_weekend",
    "is_summer", "month", "temp_F_squared", "hour_squared", "hour_cubed",
]
DEMAND_RANGE = (2_000, 11_000)


def make_features(df: DataFrame, ts: str = "energy_timestamp_mtn", month_flags: bool = False) -> DataFrame:
    featured = add_polynomials(add_calendar(df, ts))
    return add_month_flags(featured) if month_flags else featured


def training_frame(
    joined: DataFrame,
    start: datetime | str,
    end: datetime | str,
    low: float = DEMAND_RANGE[0],
    high: float = DEMAND_RANGE[1],
    month_flags: bool = False,
) -> DataFrame:
    """Joined demand and temperature in a closed time range, trimmed, complete, with features."""
    pulled = joined.filter(in_window("energy_timestamp_mtn", start, end, inclusive=True))
    complete = drop_nulls(trim_range(pulled, "energy_demand", low, high), ["energy_demand", "temp_F"])
    return make_features(complete, month_flags=month_flags)


def split_by_time(df: DataFrame, ts: str, boundaries: Sequence[tuple[datetime | str, datetime | str]]) -> list[DataFrame]:
    """One frame per open time window."""
    return [df.filter(in_window(ts, start, end, inclusive=False)) for start, end in boundaries]


def log_run(
    spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict[str, float], logged_at: datetime | None = None
) -> None:
    """Append one run to the run log."""
    row = (
        run_id,
        logged_at or datetime.now(),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
    )
    spark.createDataFrame([row], schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).parquet(path)


def best_run(runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """The run with the lowest value of a metric; the smaller id wins a tie."""
    value = F.try_element_at("metrics", F.lit(metric))
    return (
        runs.filter(value.isNotNull())
        .agg(F.min(F.struct(value.alias("value"), "run_id")).alias("best"))
        .select("best.run_id", F.col("best.value").alias(metric))
    )


def save_model(spark: SparkSession, model: LinearModel, root: str, run_id: str) -> str:
    path = f"{root}/{run_id}"
    model.save(spark, path)
    return path


def load_model(spark: SparkSession, root: str, run_id: str) -> LinearModel:
    return LinearModel.load(spark, f"{root}/{run_id}")


def train_run(
    df: DataFrame,
    ts: str,
    label: str,
    run_id: str,
    root: str,
    features: Sequence[str] = tuple(FEATURES),
    horizon: timedelta = timedelta(days=2),
    period: timedelta = timedelta(days=55),
    initial: timedelta = timedelta(days=4 * 365),
    intercept: bool = True,
    params: dict | None = None,
) -> LinearModel:
    """Fit, cross-validate, log the overall metrics and durations, store the model."""
    spark = df.sparkSession
    began = time.monotonic()
    model = fit_ols(df, features, label, intercept)
    fitted = time.monotonic()
    folds = cross_validate(df, ts, features, label, horizon, period, initial, intercept=intercept)
    overall = performance_metrics(folds, rolling_window=1).first().asDict()
    done = time.monotonic()
    overall["train_duration_minutes"] = (fitted - began) / 60
    overall["cv_duration_minutes"] = (done - fitted) / 60
    described = {"features": list(features), "cv_horizon": horizon, "cv_period": period, "cv_initial": initial}
    log_run(spark, f"{root}/runs", run_id, {**described, **(params or {})}, overall)
    save_model(spark, model, f"{root}/models", run_id)
    return model
