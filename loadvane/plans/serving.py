"""Queries behind the dashboards.

Ranges are of local dates. Where the instant that a local time was made from is at hand, it is
bounded too, so that the scan below skips what cannot be in the range.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadvane.functions.timefn import MOUNTAIN, bound_instants, in_dates, last_moment
from loadvane.plans.models import localized_predictions


def _bounded(df: DataFrame, instant: str, start: date | str, end: date | str, zone: str, ends: str = "day") -> DataFrame:
    return bound_instants(df, instant, start, last_moment(end, ends), zone) if instant in df.columns else df


def demand_in_dates(fact: DataFrame, start: date | str, end: date | str, zone: str = MOUNTAIN) -> DataFrame:
    """A demand fact, last day included, in time order."""
    near = _bounded(fact, "timestamp_UTC", start, end, zone)
    return near.filter(in_dates("timestamp_MTN", start, end)).orderBy("timestamp_MTN")


def production_forecast(
    predictions: DataFrame, model_version: str, start: date | str, end: date | str, zone: str = MOUNTAIN
) -> DataFrame:
    """First-day predictions of one model, up to midnight of the last day."""
    near = _bounded(predictions, "energy_timestamp_mtn", start, end, zone, ends="midnight")
    return (
        localized_predictions(near.filter(F.col("model_version") == model_version), zone)
        .filter(F.col("hours_from_pred_start") < 24)
        .filter(in_dates("energy_timestamp_mtn", start, end, ends="midnight"))
        .select(
            F.col("energy_timestamp_mtn").alias("timestamp_MTN"),
            "predicted_energy_demand",
            "temp_f_forecast",
            "model_version",
        )
        .orderBy("timestamp_MTN")
    )


def temperature_in_dates(
    temperature: DataFrame, start: date | str, end: date | str, zone: str = MOUNTAIN
) -> DataFrame:
    """Recorded temperature up to midnight of the last day, in time order."""
    near = _bounded(temperature, "observation_time_UTC", start, end, zone, ends="midnight")
    return near.filter(in_dates("observation_time_MTN", start, end, ends="midnight")).orderBy("observation_time_MTN")


def monitoring_window(
    metrics: DataFrame, start: date | str, end: date | str, model_version: str | None = None
) -> DataFrame:
    """Metric rows with a lead of at most 24 hours, last day included."""
    kept = metrics.filter((F.col("hours_from_pred_start") <= 24) & in_dates("energy_timestamp_mtn", start, end))
    return kept if model_version is None else kept.filter(F.col("model_version") == model_version)
