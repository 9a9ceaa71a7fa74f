"""Staging, core and mart models, as functions of their inputs.

``within`` may give the first and last local time that is asked for later: the model then reads
only rows whose instant may show one between them, by a test on the raw column that reaches the
scan. It narrows what is read and does not replace the exact test on the local time.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadvane.functions.columns import error_columns, fahrenheit, good_quality, station_key, strict_cast
from loadvane.functions.timefn import MOUNTAIN, bound_instants, hours_between, ntz, to_local, trunc_hour
from loadvane.operators.joins import left_join_dealt
from loadvane.session import settle

Within = tuple[datetime | str, datetime | str] | None

# The series of actual demand and of the utility's day-ahead forecast.
ACTUAL_SERIES = "EBA_PSCO-ALL_D_H"
UTILITY_FORECAST_SERIES = "EBA_PSCO-ALL_DF_H"


def _near(df: DataFrame, instant: str, within: Within, zone: str) -> DataFrame:
    return df if within is None else bound_instants(df, instant, *within, zone)


def demand_fact(
    demand: DataFrame, metadata: DataFrame, series_id: str, zone: str = MOUNTAIN, within: Within = None
) -> DataFrame:
    """One demand series on both clocks with its unit, name and update time."""
    series = _near(demand, "timestamp", within, zone).filter(F.col("series_id") == series_id).select("series_id", "timestamp", "value")
    about = metadata.filter(F.col("series_id") == series_id).select("series_id", "units", "name", "updated")
    return series.join(about, "series_id").select(
        "series_id",
        F.col("timestamp").alias("timestamp_UTC"),
        to_local("timestamp", zone).alias("timestamp_MTN"),
        "value",
        "units",
        "name",
        "updated",
    )


def _weather(lat: str, lon: str, celsius: str, instant: Column, zone: str) -> list[Column]:
    return [
        F.col(lat).alias("lat"),
        F.col(lon).alias("lon"),
        F.col(celsius).alias("temp_C"),
        fahrenheit(celsius).alias("temp_F"),
        ntz(instant).alias("observation_time_UTC"),
        to_local(instant, zone).alias("observation_time_MTN"),
    ]


def station_weather(observations: DataFrame, stations: DataFrame, zone: str = MOUNTAIN) -> DataFrame:
    """Quality-gated station observations with the location of their station."""
    places = stations.select(station_key("USAF", "WBAN").alias("station_id"), "LAT", "LON")
    kept = observations.filter(good_quality("temperature_QC", "temperature_degC"))
    return (
        kept.withColumn("station_id", F.col("STATION").cast("string"))
        .join(places, "station_id")
        .select(*_weather("LAT", "LON", "temperature_degC", strict_cast("DATE", "timestamp"), zone))
    )


def live_weather(observations: DataFrame, zone: str = MOUNTAIN, within: Within = None) -> DataFrame:
    """Live observations in the same six columns."""
    return _near(observations, "timestamp", within, zone).select(*_weather("lat", "lon", "temp", F.col("timestamp"), zone))


def union_years(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def recorded_temperature(sources: dict[str, DataFrame]) -> DataFrame:
    """All weather casts, each row tagged with its source."""
    return reduce(
        DataFrame.unionByName, [df.withColumn("source", F.lit(tag)) for tag, df in sources.items()]
    )


def joined_temp_demand(
    demand: DataFrame, temperature: DataFrame, on: str = "local", one_per_hour: str | None = None
) -> DataFrame:
    """Demand with the temperatures of its hour; hours without one keep null columns.

    The default joins on the local hour and keeps every temperature of it, so the
    doubled hour of the autumn clock change meets all four combinations. ``on="utc"``
    separates the two; ``one_per_hour="latest"`` keeps the last observation.
    """
    if on not in ("local", "utc"):
        raise ValueError(f"on must be 'local' or 'utc', not {on!r}")
    clock = {"local": ("observation_time_MTN", "timestamp_MTN"), "utc": ("observation_time_UTC", "timestamp_UTC")}[on]
    temps = temperature.withColumn("hour_key", trunc_hour(clock[0])).filter(F.col("hour_key").isNotNull())
    if one_per_hour == "latest":
        row = ["observation_time_MTN", "observation_time_UTC", "temp_F", "temp_C", "lat", "lon", "source"]
        temps = temps.groupBy("hour_key").agg(F.max(F.struct("observation_time_UTC", *[c for c in row if c != "observation_time_UTC"])).alias("r")).select("hour_key", "r.*")
    elif one_per_hour is not None:
        raise ValueError(f"one_per_hour must be 'latest' or None, not {one_per_hour!r}")
    energy = demand.withColumn("hour_key", trunc_hour(clock[1]))
    return left_join_dealt(energy, temps, ["hour_key"]).select(
        F.col("observation_time_MTN").alias("temp_timestamp_mtn"),
        F.col("timestamp_MTN").alias("energy_timestamp_mtn"),
        F.col("value").alias("energy_demand"),
        F.col("units").alias("demand_units"),
        F.col("name").alias("series_name"),
        "temp_F",
        "temp_C",
        F.col("lat").alias("temp_location_lat"),
        F.col("lon").alias("temp_location_lon"),
        F.col("source").alias("temp_source"),
        F.col("updated").alias("date_energy_updated"),
    )


def localized_predictions(predictions: DataFrame, zone: str = MOUNTAIN) -> DataFrame:
    """Stored predictions on the local clock with their lead in hours."""
    return predictions.select(
        to_local("energy_timestamp_mtn", zone).alias("energy_timestamp_mtn"),
        "predicted_energy_demand",
        "temp_f_forecast",
        "model_version",
        to_local("prediction_start_date", zone).alias("prediction_start_date"),
        "prediction_creation_date",
    ).withColumn("hours_from_pred_start", hours_between("energy_timestamp_mtn", "prediction_start_date"))


def model_metrics(
    predictions: DataFrame,
    joined: DataFrame,
    demand: DataFrame | None = None,
    zone: str = MOUNTAIN,
    within: Within = None,
) -> DataFrame:
    """Every prediction against the actuals of its local time, with eight error columns.

    ``energy_timestamp_mtn`` is the actual's time and null without one;
    ``forecast_timestamp_mtn`` always holds the predicted time. The actuals from the first
    predicted time to the last are stored once, so ``joined`` may be a plan of its own and
    ``demand``, the fact it came from, is not needed. The result is narrow and may be stored
    with ``settle`` where several queries read it.
    """
    forecasts = localized_predictions(_near(predictions, "energy_timestamp_mtn", within, zone), zone).withColumnRenamed(
        "energy_timestamp_mtn", "forecast_timestamp_mtn"
    )
    times = forecasts.agg(F.min("forecast_timestamp_mtn").alias("since"), F.max("forecast_timestamp_mtn").alias("until"))
    since, until = times.select("since").scalar(), times.select("until").scalar()
    compared = ["energy_timestamp_mtn", "temp_timestamp_mtn", "energy_demand", "demand_units", "series_name", "temp_F", "date_energy_updated"]
    actuals = settle(joined.select(*compared).filter(F.col("energy_timestamp_mtn").between(since, until)), "actuals").withColumn(
        "forecast_timestamp_mtn", F.col("energy_timestamp_mtn")
    )
    return left_join_dealt(forecasts, actuals, ["forecast_timestamp_mtn"]).select(
        "energy_timestamp_mtn",
        "predicted_energy_demand",
        "temp_f_forecast",
        "model_version",
        "prediction_start_date",
        "prediction_creation_date",
        "hours_from_pred_start",
        "temp_timestamp_mtn",
        "energy_demand",
        "demand_units",
        "series_name",
        "temp_F",
        "date_energy_updated",
        *error_columns("energy_demand", "predicted_energy_demand", "energy"),
        *error_columns("temp_F", "temp_f_forecast", "temp_f"),
        "forecast_timestamp_mtn",
    )
