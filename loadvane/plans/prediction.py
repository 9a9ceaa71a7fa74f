"""Daily batch prediction from the forecast known at the start of the day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadvane.functions.timefn import MOUNTAIN, ntz_literal, to_instant, to_local
from loadvane.operators.asof import forecast_as_of
from loadvane.operators.regression import LinearModel
from loadvane.operators.series import upsample
from loadvane.plans.training import make_features


def hourly_forecast(
    forecasts: DataFrame, start: datetime | str, zone: str = MOUNTAIN, keys: Sequence[str] = (), method: str = "cubic"
) -> DataFrame:
    """Hourly temperature as it was forecast at local time ``start``, on both clocks."""
    as_of = to_instant(ntz_literal(start), zone)
    known = forecast_as_of(
        forecasts.withColumns(
            {c: F.col(c).cast("timestamp") for c in ("forecast_time", "creation_time")}
        ),
        as_of,
        keys,
    )
    hourly = upsample(known, keys, "forecast_time", "temp_F", method=method)
    return hourly.select(
        *keys, "forecast_time", to_local("forecast_time", zone).alias("energy_timestamp_mtn"), "temp_F"
    )


def prediction_frame(
    scored: DataFrame,
    run_id: str,
    start: datetime | str,
    created: datetime | str,
    zone: str = MOUNTAIN,
    predicted: str = "predicted",
    keys: Sequence[str] = (),
) -> DataFrame:
    """The stored columns: times as instants, the run and its times as constants."""
    return scored.select(
        *keys,
        F.col("forecast_time").cast("timestamp").alias("energy_timestamp_mtn"),
        F.col(predicted).alias("predicted_energy_demand"),
        F.col("temp_F").cast("double").alias("temp_f_forecast"),
        F.lit(run_id).alias("model_version"),
        to_instant(ntz_literal(start), zone).alias("prediction_start_date"),
        F.lit(str(created)).cast("timestamp").alias("prediction_creation_date"),
    )


def batch_predict(
    forecasts: DataFrame,
    model: LinearModel,
    run_id: str,
    start: datetime | str,
    created: datetime | str,
    zone: str = MOUNTAIN,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Forecast known at ``start`` to hourly features to predictions.

    The spline sorts its points into stored ranges when this is called; the rest is lazy.
    """
    hourly = hourly_forecast(forecasts, start, zone, keys)
    scored = model.predict(make_features(hourly))
    return prediction_frame(scored, run_id, start, created, zone, keys=keys)
