"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane import schemas
from loadvane.functions import columns as C
from loadvane.functions import timefn as TF
from loadvane.gate.inputs import GRID, Tables, scaled_text
from loadvane.operators import asof, grid, metrics, profiles, regression, rolling, series
from loadvane.plans import models, prediction, serving, training
from loadvane.session import fresh_dir, ship_package, use_utc
from loadvane.sources import documents, lake, versions
from loadvane.streaming.live import land_live_weather, read_landed

START, END = "2024-01-10", "2024-01-20"
AS_OF = "2024-01-15"
RUN = "run-1"
YEARS = list(range(1995, 2003))
CV = {"horizon": timedelta(days=10), "initial": timedelta(days=1460), "period": timedelta(days=55)}
CV_WINDOW = 25

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def present(df: DataFrame) -> DataFrame:
    """Comparable output: instants as UTC wall clocks, doubles to six places."""
    shown = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            c = F.round(c, 6) + F.lit(0.0)
        shown.append(c.alias(field.name))
    return df.select(*shown)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(use_utc(spark))
            return present(fn(Tables(spark, folder)))

        return run

    return {name: bind(fn) for name, fn in REGISTRY.items()}


# Shared models


def actual_fact(t: Tables) -> DataFrame:
    return models.demand_fact(t.demand_hourly(), t.metadata(), "view")


def temperature(t: Tables) -> DataFrame:
    return models.recorded_temperature(
        {
            "isd": models.station_weather(t.station_observations(), t.stations()),
            "owm": models.live_weather(t.live_observations()),
        }
    )


def joined(t: Tables) -> DataFrame:
    return models.joined_temp_demand(actual_fact(t), temperature(t))


def metric_rows(t: Tables) -> DataFrame:
    return models.model_metrics(t.predictions(), joined(t))


def cv_rows(t: Tables) -> DataFrame:
    folds = regression.cross_validate(t.daily_demand(), "ds", ["temp_F"], "y", **CV)
    return folds.withColumn("yhat", F.round("yhat", 4))


def bounded_cv(t: Tables) -> DataFrame:
    return cv_rows(t).withColumns({"yhat_lower": F.col("yhat") * 0.9, "yhat_upper": F.col("yhat") * 1.1})


def featured_daily(t: Tables) -> DataFrame:
    return training.make_features(t.daily_demand(), "ds")


# Sources


@query
def parse_eia_values(t):
    return documents.parse_demand_values(t.demand_documents())


@query
def parse_eia_metadata(t):
    return documents.parse_demand_metadata(t.demand_documents()).withColumn("others", F.to_json("others"))


@query
def parse_isd_obs(t):
    return documents.parse_station_lines(t.station_lines())


@query
def parse_live_weather(t):
    return documents.parse_live_weather(t.live_documents())


@query
def parse_forecast_xml(t):
    return documents.parse_forecast_xml(t.forecast_documents())


@query
def station_seed(t):
    path = fresh_dir(t.spark, "stations")
    t.stations().write.option("header", "true").csv(path)
    return documents.read_stations(t.spark, path).withColumn("station_id", C.station_key("USAF", "WBAN"))


@query
def scan_partition_pruned(t):
    root = fresh_dir(t.spark, "lake")
    lake.stage(t.yearly_observations(), "weather_station", root)
    return lake.scan_staged(t.spark, "weather_station", root).filter(F.col("year") == 1998)


@query
def reprocess_live_weather(t):
    raw = fresh_dir(t.spark, "raw-live")
    half_day = F.when(F.hour("timestamp") < 12, "-00").otherwise("-12")
    stamp = F.concat(F.date_format("timestamp", "yyyy-MM-dd"), half_day)
    lines = t.live_documents().select("value", stamp.alias("landed")).repartition("landed")
    # one document per line here, so the reader is the line-based one
    lines.write.partitionBy("landed").text(raw)
    root = fresh_dir(t.spark, "live-table")
    # all hours, landed when one of the fields was not extracted yet
    early, late = datetime(2000, 1, 1), datetime(2100, 1, 1)
    old = documents.reprocess_live_weather(t.spark, raw, early, late, wholetext=False)
    versions.replace_range(old.withColumn("feels_like", F.lit(None).cast("double")), root, "landed", "2000-01-01-00", "2100-01-01-00")
    for _ in range(2):
        documents.rewrite_live_weather(t.spark, raw, root, datetime(2024, 1, 10, 0), datetime(2024, 1, 20, 12), wholetext=False)
    return versions.read_versions(t.spark, root, old.schema, "landed")


# Sinks


@query
def typed_write_roundtrip(t):
    path = fresh_dir(t.spark, "typed")
    lake.write_typed(t.demand(), schemas.DEMAND_DATA, path, ["series_id"])
    return t.spark.read.schema(schemas.DEMAND_DATA).parquet(path)


def _table(t: Tables, label: str) -> tuple[str, str]:
    path = fresh_dir(t.spark, label)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


@query
def overwrite_twice(t):
    name, path = _table(t, "overwritten")
    lake.publish_overwrite(t.demand().filter(F.col("series_id") == "view"), name, path)
    lake.publish_overwrite(t.demand(), name, path)
    return t.spark.table(name)


@query
def append_twice(t):
    name, path = _table(t, "appended")
    lake.publish_append(t.demand(), name, path)
    lake.publish_append(t.demand(), name, path)
    return t.spark.table(name)


@query
def materialize_models(t):
    """A model kept as a table, and one over it that is a view."""
    name, path = _table(t, "recorded")
    lake.materialize(lambda: temperature(t), name, "table", path)
    hottest = t.spark.table(name).groupBy("source", "lat", "lon").agg(F.max("temp_F").alias("hottest"), F.count(F.lit(1)).alias("n"))
    return lake.materialize(lambda: hottest, f"{name}_hottest", "view")


# Scalar functions


@query
def local_time(t):
    at = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return t.read("orders").select("o_orderkey", TF.to_local(at).alias("local"))


@query
def local_to_utc(t):
    return t.read("events").select("event_id", TF.to_instant("ts").alias("instant"))


@query
def split_scaled_field(t):
    value, flag = C.split_scaled("field")
    fields = t.station_observations().select(scaled_text("temperature_degC", "temperature_QC").alias("field"))
    return fields.select("field", value.alias("value"), flag.alias("flag"))


@query
def temp_f(t):
    return t.live_observations().select("temp", C.fahrenheit("temp").alias("temp_F"))


@query
def normalize_series_id(t):
    raw = F.concat(F.lit("EBA."), F.upper("event_type"), F.lit(".D.H"))
    return t.read("events").select("event_id", C.normalize_series_id(raw).alias("series_id"))


@query
def parse_timestamps(t):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    texts = t.read("events").select(
        "event_id",
        F.date_format("ts", "yyyyMMdd'T'HH'Z'").alias("compact"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-06:00")).alias("iso"),
        seconds.alias("seconds"),
    )
    return texts.select(
        "event_id",
        TF.parse_compact_hour("compact").alias("compact"),
        TF.parse_iso("iso").alias("iso"),
        TF.parse_epoch("seconds").alias("epoch"),
    )


@query
def calendar_features(t):
    return TF.add_calendar(t.shipments(), "ts")


@query
def poly_features(t):
    return C.add_polynomials(TF.add_calendar(t.shipments(), "ts")).select(
        "ts", "temp_F", "temp_F_squared", "hour_squared", "hour_cubed"
    )


@query
def month_dummies(t):
    return C.add_month_flags(t.shipments().select("ts", F.month("ts").alias("month")))


@query
def error_columns(t):
    # k reaches 0, a zero actual
    return t.events.select("event_id", *C.error_columns(F.col("k").cast("double"), F.col("value"), "energy"))


@query
def hour_diff(t):
    earlier = F.col("ts") - F.make_dt_interval(mins=(F.col("user_id") % 500).cast("int"))
    return t.read("events").select("event_id", TF.hours_between("ts", earlier).alias("hours"))


# Filters


@query
def quality_filter(t):
    return t.station_observations().filter(C.good_quality("temperature_QC", "temperature_degC"))


@query
def trim_range(t):
    return C.trim_range(t.shipments(), "value", 2_000, 11_000)


@query
def drop_null_subset(t):
    return C.drop_nulls(joined(t), ["energy_demand", "temp_F"])


@query
def train_val_split(t):
    parts = training.split_by_time(
        t.shipments(), "ts", [("1995-08-01", "2000-01-01"), ("2000-01-01", "2000-06-01")]
    )
    return parts[0].withColumn("part", F.lit("train")).unionByName(parts[1].withColumn("part", F.lit("validate")))


@query
def date_range_two_ways(t):
    days = t.demand_hourly()
    whole = days.filter(TF.in_dates("timestamp", START, END)).withColumn("ends", F.lit("day"))
    cut = days.filter(TF.in_dates("timestamp", START, END, ends="midnight")).withColumn("ends", F.lit("midnight"))
    return whole.unionByName(cut)


# Point-in-time selection


@query
def forecast_as_of(t):
    return asof.forecast_as_of(t.forecasts(), TF.ntz(TF.to_instant(TF.ntz_literal(AS_OF))), ["lat", "lon"])


@query
def forecast_as_of_many(t):
    moments = t.read("events").select(TF.ntz(F.date_trunc("day", "ts")).alias("as_of")).distinct()
    return asof.forecast_as_of_many(t.forecasts(), moments, ["lat", "lon"])


# Aggregations


def _profile(name: str, by: Callable[[], dict]) -> None:
    def run(t):
        return profiles.profile(t.shipments(), by(), "value")

    REGISTRY[name] = run


_profile("profile_year", lambda: {"year": F.year("ts")})
_profile("profile_month", lambda: {"month": F.month("ts")})
_profile("profile_weekday", lambda: {"weekday": F.weekday("ts")})
_profile("profile_hour", lambda: {"hour": F.hour("ts")})
_profile("profile_month_hour", lambda: {"month": F.month("ts"), "hour": F.hour("ts")})
_profile("profile_by_value", lambda: {"temp_F": F.col("temp_F")})
_profile("profile_month_value", lambda: {"month": F.month("ts"), "temp_F": F.col("temp_F")})


@query
def mean_by_weekday(t):
    return profiles.mean_by(t.shipments(), {"weekday": F.weekday("ts")}, "value")


@query
def pivot_hour_month(t):
    return profiles.pivot_hour_month(t.shipments(), "ts", "value")


@query
def daily_sum_dense(t):
    sums = profiles.daily_sum_dense(t.read("orders"), "o_orderdate", "o_totalprice")
    return sums.select("day", F.round("total", 3).alias("total"))


@query
def distinct_versions(t):
    return profiles.distinct_versions(metric_rows(t))


@query
def monitor_kpis(t):
    return profiles.kpis(metric_rows(t))


@query
def monitor_kpis_by_version(t):
    return profiles.kpis(metric_rows(t), ["model_version"])


@query
def describe_numeric(t):
    return profiles.describe(t.shipments(), ["value", "temp_F"])


@query
def null_counts(t):
    return profiles.null_counts(joined(t))


@query
def rows_with_null(t):
    return profiles.rows_with_null(joined(t), "temp_F")


@query
def null_observations(t):
    return profiles.rows_with_null(t.station_observations(), "temperature_degC")


@query
def error_histogram(t):
    return profiles.histogram(metric_rows(t), "energy_error")


# Windows


@query
def median_filter(t):
    cleaned = t.read("events").select(
        "event_id", "event_type", "ts", C.positive_or_null("value").alias("value")
    )
    return series.median_filter(cleaned, ["event_type"], "ts", "value", tie=["event_id"])


@query
def rolling_mean_by_horizon(t):
    points = metrics.with_horizon(cv_rows(t))
    return rolling.rolling_means(points, {"mean": F.col("y")}, CV_WINDOW)


@query
def rolling_median_by_horizon(t):
    points = metrics.with_horizon(cv_rows(t))
    return rolling.rolling_median(points, F.col("y"), "median", CV_WINDOW)


# Sorts and unions


@query
def station_topk(t):
    return profiles.station_search(t.stations(), "CO", "2022-01-01", "AIRPORT", limit=100)


@query
def union_years(t):
    root = fresh_dir(t.spark, "lake")
    lake.stage(t.yearly_observations(), "weather_station", root)
    staged = lake.scan_staged(t.spark, "weather_station", root)
    return models.union_years([staged.filter(F.col("year") == y).drop("year") for y in YEARS])


# Time series


@query
def upsample_cubic(t):
    return series.upsample(t.newest_forecast(), ["lat", "lon"], "forecast_time", "temp_F")


@query
def upsample_linear(t):
    return series.upsample(t.newest_forecast(), ["lat", "lon"], "forecast_time", "temp_F", method="linear")


@query
def future_frame(t):
    return series.make_future(t.demand(), "timestamp", 3600, 36, keys=["series_id"])


# Models


@query
def fact_demand_actual(t):
    return models.demand_fact(t.demand(), t.metadata(), "view")


@query
def fact_demand_forecast(t):
    return models.demand_fact(t.demand(), t.metadata(), "click")


@query
def cast_station_weather(t):
    return models.station_weather(t.station_observations(), t.stations())


@query
def cast_live_weather(t):
    return models.live_weather(t.live_observations())


@query
def recorded_temperature(t):
    return temperature(t)


@query
def joined_temp_demand(t):
    return joined(t)


@query
def joined_temp_demand_latest(t):
    return models.joined_temp_demand(actual_fact(t), temperature(t), on="utc", one_per_hour="latest")


@query
def model_metrics(t):
    return metric_rows(t)


# Forecast model


@query
def ols_univariate(t):
    model = regression.fit_ols(t.shipments(), ["temp_F"], "value")
    fitted = [(model.coefficients[0], model.intercept)]
    pair = t.spark.createDataFrame(fitted, "slope double, intercept double")
    return pair.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query
def ols_full(t):
    rows = featured_daily(t)
    model = regression.fit_ols(rows, training.FEATURES, "y")
    fitted = [("intercept", model.intercept), *zip(model.features, model.coefficients)]
    weights = t.spark.createDataFrame(fitted, "feature string, coefficient double")
    return weights.withColumn("coefficient", F.round("coefficient", 3))


@query
def ols_predict(t):
    rows = t.shipments()
    model = regression.fit_ols(rows, ["temp_F"], "value")
    return model.predict(rows).select(
        "ts", "temp_F", "value", F.round("predicted", 4).alias("predicted")
    )


@query
def cv_cutoffs(t):
    return regression.cutoff_frame(t.daily_demand(), "ds", **CV)


@query
def cv_univariate(t):
    return cv_rows(t)


@query
def cv_full(t):
    folds = regression.cross_validate(featured_daily(t), "ds", training.FEATURES, "y", **CV)
    return folds.withColumn("yhat", F.round("yhat", 4))


def _logged_runs(t: Tables) -> DataFrame:
    root = fresh_dir(t.spark, "runs")
    for run_id, intercept in (("with-intercept", True), ("through-origin", False)):
        training.train_run(t.daily_demand(), "ds", "y", run_id, root, ["temp_F"], intercept=intercept, **CV)
    return training.read_runs(t.spark, f"{root}/runs")


@query
def run_log(t):
    logged = ["mse", "rmse", "mae", "mape", "mdape", "smape"]
    return _logged_runs(t).select(
        "run_id", *[F.round(F.try_element_at("metrics", F.lit(m)), 4).alias(m) for m in logged]
    )


@query
def best_run(t):
    return training.best_run(_logged_runs(t)).withColumn("rmse", F.round("rmse", 4))


@query
def model_roundtrip(t):
    rows = t.daily_demand()
    root = fresh_dir(t.spark, "models")
    training.save_model(t.spark, regression.fit_ols(rows, ["temp_F"], "y"), root, RUN)
    scored = training.load_model(t.spark, root, RUN).predict(rows)
    return scored.select("ds", "y", F.round("predicted", 4).alias("predicted"))


@query
def prediction_frame(t):
    model = regression.fit_ols(t.shipments(), ["temp_F"], "value")
    rows = t.newest_forecast()
    scored = model.predict(rows)
    framed = prediction.prediction_frame(scored, RUN, AS_OF, "2024-01-15 06:00:00", keys=["lat", "lon"])
    return framed.withColumn("predicted_energy_demand", F.round("predicted_energy_demand", 4))


@query
def batch_predict(t):
    rows = featured_daily(t)
    root = fresh_dir(t.spark, "models")
    training.save_model(t.spark, regression.fit_ols(rows, training.FEATURES, "y"), root, RUN)
    predicted = prediction.batch_predict(
        t.forecasts(), training.load_model(t.spark, root, RUN), RUN, AS_OF, "2024-01-15 06:00:00", keys=["lat", "lon"]
    )
    name, path = _table(t, "predictions")
    lake.publish_append(predicted, name, path)
    return t.spark.table(name).withColumn("predicted_energy_demand", F.round("predicted_energy_demand", 4))


# Evaluation


def _metric(name: str) -> None:
    def run(t):
        return metrics.metric(metrics.with_horizon(bounded_cv(t)), name, CV_WINDOW)

    REGISTRY[f"metric_{name}"] = run


for _name in metrics.METRICS:
    _metric(_name)


@query
def performance_metrics(t):
    return metrics.performance_metrics(bounded_cv(t))


@query
def performance_overall(t):
    return metrics.performance_metrics(cv_rows(t), rolling_window=1)


@query
def performance_monthly(t):
    return metrics.performance_metrics(bounded_cv(t), rolling_window=0, monthly=True)


@query
def performance_pointwise(t):
    return metrics.performance_metrics(bounded_cv(t), rolling_window=-1)


# Serving


@query
def serve_actual(t):
    return serving.demand_in_dates(models.demand_fact(t.demand(), t.metadata(), "view"), START, END)


@query
def serve_utility_forecast(t):
    return serving.demand_in_dates(models.demand_fact(t.demand(), t.metadata(), "click"), START, END)


@query
def serve_model_forecast(t):
    return serving.production_forecast(t.predictions(), "v0", START, END)


@query
def serve_temperature(t):
    return serving.temperature_in_dates(temperature(t), START, END)


@query
def serve_monitoring(t):
    return serving.monitoring_window(metric_rows(t), START, END)


# Grids


@query
def grid_project(t):
    x, y = GRID.project("lon", "lat")
    return t.customer_points().select("point", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query
def grid_cube(t):
    cube = grid.grid_cube(t.grid_messages(), GRID)
    return cube.withColumns({"x": F.round("x", 3), "y": F.round("y", 3)})


@query
def grid_nearest(t):
    return grid.grid_series(t.grid_messages(), t.nation_points(), GRID).select(
        "point", "valid_time", "iy", "ix", "value"
    )


# Streaming


@query
def stream_live_weather(t):
    raw, out, state = (fresh_dir(t.spark, label) for label in ("raw-stream", "landed", "stream-state"))
    docs = t.live_documents().select("value")
    # every observation is landed twice, in different files
    docs.write.text(raw)
    docs.write.mode("append").text(raw)
    land_live_weather(t.spark, raw, out, state, wholetext=False).awaitTermination()
    return read_landed(t.spark, out).select(*schemas.LIVE_WEATHER.names)
