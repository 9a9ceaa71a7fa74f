from datetime import datetime as D
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from loadvane.operators import profiles, regression
from loadvane.plans import models, prediction, serving, training


def demand(spark, rows, series="S"):
    df = spark.createDataFrame([(series, D.fromisoformat(t), v) for t, v in rows], "series_id string, timestamp timestamp_ntz, value double")
    about = spark.createDataFrame([(series, "MWh", "Demand", "u"), ("other", "MWh", "x", "u")], "series_id string, units string, name string, updated string")
    return models.demand_fact(df.unionByName(df.withColumn("series_id", F.lit("other"))), about, series)


def temperature(spark, rows):
    live = spark.createDataFrame([(39.8, -104.6, float(c), D.fromisoformat(t)) for t, c in rows], "lat double, lon double, temp double, timestamp timestamp_ntz")
    return models.recorded_temperature({"owm": models.live_weather(live)})


FOLD = ["2022-11-06 07:00:00", "2022-11-06 08:00:00"]


def test_fact_keeps_one_series_and_caps_on_request(spark):
    fact = demand(spark, [("2022-07-01 06:00:00", 1.0), ("2022-07-01 05:00:00", None)])
    assert sorted(r.timestamp_MTN for r in fact.collect()) == [D(2022, 6, 30, 23), D(2022, 7, 1)]


def test_station_cast_gates_quality_and_joins_padded_keys(spark):
    obs = spark.createDataFrame(
        [("00702600999", "2022-07-01T06:30:00", 20.0, "1"), ("00702600999", "2022-07-01T07:30:00", 20.0, "2"),
         ("00702600999", "2022-07-01T08:30:00", None, "1"), ("99999999999", "2022-07-01T06:30:00", 20.0, "1")],
        "STATION string, DATE string, temperature_degC double, temperature_QC string",
    )
    stations = spark.createDataFrame([("007026", "00999", 39.5, -104.8)], "USAF string, WBAN string, LAT double, LON double")
    assert [tuple(r) for r in models.station_weather(obs, stations).collect()] == [
        (39.5, -104.8, 20.0, 68.0, D(2022, 7, 1, 6, 30), D(2022, 7, 1, 0, 30))
    ]


def test_join_fans_out_and_fills_with_nulls(spark):
    fact = demand(spark, [("2022-07-01 06:00:00", 1.0), ("2022-07-01 07:00:00", 2.0)])
    temps = temperature(spark, [("2022-07-01 06:10:00", 10), ("2022-07-01 06:50:00", 11), ("2022-07-01 09:00:00", 12)])
    rows = models.joined_temp_demand(fact, temps).collect()
    assert sorted((r.energy_demand, r.temp_C or 0.0) for r in rows) == [(1.0, 10.0), (1.0, 11.0), (2.0, 0.0)]
    latest = models.joined_temp_demand(fact, temps, one_per_hour="latest").collect()
    assert sorted((r.energy_demand, r.temp_C or 0.0) for r in latest) == [(1.0, 11.0), (2.0, 0.0)]


def test_autumn_hour_meets_crosswise_by_default(spark):
    fact = demand(spark, [(t, float(i)) for i, t in enumerate(FOLD)])
    temps = temperature(spark, [(t, i) for i, t in enumerate(FOLD)])
    assert models.joined_temp_demand(fact, temps).count() == 4
    rows = models.joined_temp_demand(fact, temps, on="utc").collect()
    assert sorted((r.energy_demand, r.temp_C) for r in rows) == [(0.0, 0.0), (1.0, 1.0)]
    for bad in ({"on": "mars"}, {"one_per_hour": "first"}):
        with pytest.raises(ValueError):
            models.joined_temp_demand(fact, temps, **bad)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_join_does_not_depend_on_the_join_strategy(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        fact = demand(spark, [(f"2022-07-01 {h:02d}:00:00", float(h)) for h in range(24)])
        temps = temperature(spark, [("2022-07-01 06:10:00", i) for i in range(500)] + [("2022-07-01 07:10:00", 1)])
        assert models.joined_temp_demand(fact, temps).count() == 22 + 500 + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def predictions(spark, rows):
    shape = (
        "energy_timestamp_mtn timestamp, predicted_energy_demand double, temp_f_forecast double, model_version string, "
        "prediction_start_date timestamp, prediction_creation_date timestamp"
    )
    stamped = [(D.fromisoformat(t), p, f, v, D.fromisoformat(s), D.fromisoformat(s)) for t, p, f, v, s in rows]
    return spark.createDataFrame(stamped, shape.replace("timestamp,", "timestamp_ntz,")).select(
        *[F.col(c).cast("timestamp").alias(c) if c.endswith(("mtn", "date")) else F.col(c) for c in (
            "energy_timestamp_mtn", "predicted_energy_demand", "temp_f_forecast", "model_version",
            "prediction_start_date", "prediction_creation_date")]
    )


def metric_rows(spark):
    fact = demand(spark, [("2022-07-01 06:00:00", 100.0), ("2022-07-01 07:00:00", 0.0), ("2022-07-01 08:00:00", 50.0)])
    # 0 °F is a real temperature
    temps = temperature(spark, [("2022-07-01 06:00:00", 10), ("2022-07-01 08:00:00", -17.8)])
    made = predictions(
        spark,
        [
            ("2022-07-01 06:00:00", 90.0, 49.0, "a", "2022-07-01 06:00:00"),
            ("2022-07-01 07:00:00", 5.0, 49.0, "a", "2022-07-01 06:00:00"),
            ("2022-07-01 08:00:00", 60.0, 1.0, "b", "2022-06-30 06:00:00"),
            ("2022-07-02 09:00:00", 60.0, 1.0, "b", "2022-07-01 06:00:00"),
        ],
    )
    joined = models.joined_temp_demand(fact, temps)
    return models.model_metrics(made, joined), models.model_metrics(made, joined, demand=fact)


def test_model_metrics(spark):
    plain, hinted = metric_rows(spark)
    assert len(plain.columns) == 22
    rows = {r.forecast_timestamp_mtn: r for r in plain.collect()}
    assert {k: tuple(v) for k, v in rows.items()} == {r.forecast_timestamp_mtn: tuple(r) for r in hinted.collect()}
    first, zero, cold, unmatched = (rows[k] for k in sorted(rows))
    assert (first.energy_error, first.energy_error_abs_pct, first.temp_f_error) == (10.0, 0.1, 1.0)
    assert (zero.energy_error, zero.energy_error_pct, zero.temp_F) == (-5.0, None, None)
    assert cold.temp_F == 0.0 and cold.temp_f_error_pct is None and cold.hours_from_pred_start == 26
    assert unmatched.energy_timestamp_mtn is None and unmatched.energy_error is None


def test_monitoring_and_kpis(spark):
    metrics, _ = metric_rows(spark)
    window = serving.monitoring_window(metrics, "2022-07-01", "2022-07-01")
    assert window.count() == 2
    assert serving.monitoring_window(metrics, "2022-07-01", "2022-07-01", "b").count() == 0
    row = profiles.kpis(window).first()
    assert (row.energy_me, row.energy_mae, row.energy_mape, row.temp_f_mape) == (2.5, 7.5, 10.0, 2.0)
    assert profiles.kpis(metrics, ["model_version"]).count() == 2
    assert sorted(r[0] for r in profiles.distinct_versions(metrics).collect()) == ["a", "b"]


def test_serving_ranges(spark):
    fact = demand(spark, [("2022-07-01 06:00:00", 1.0), ("2022-07-02 06:00:00", 2.0), ("2022-07-02 07:00:00", 3.0)])
    assert [r.value for r in serving.demand_in_dates(fact, "2022-07-01", "2022-07-02").collect()] == [1.0, 2.0, 3.0]
    temps = temperature(spark, [("2022-07-01 06:00:00", 1), ("2022-07-02 06:00:00", 2), ("2022-07-02 07:00:00", 3)])
    assert [r.temp_C for r in serving.temperature_in_dates(temps, "2022-07-01", "2022-07-02").collect()] == [1.0, 2.0]
    made = predictions(spark, [
        ("2022-07-02 05:00:00", 1.0, 1.0, "a", "2022-07-01 06:00:00"), ("2022-07-02 06:00:00", 2.0, 1.0, "a", "2022-07-01 06:00:00"),
        ("2022-07-02 05:00:00", 3.0, 1.0, "b", "2022-07-01 06:00:00"),
    ])
    assert [r.predicted_energy_demand for r in serving.production_forecast(made, "a", "2022-07-01", "2022-07-02").collect()] == [1.0]


def test_training_frame(spark):
    fact = demand(spark, [("2022-07-01 06:00:00", 5000.0), ("2022-07-01 07:00:00", 1.0), ("2022-07-01 08:00:00", 5000.0)])
    temps = temperature(spark, [("2022-07-01 06:00:00", 10), ("2022-07-01 07:00:00", 10)])
    frame = training.training_frame(models.joined_temp_demand(fact, temps), "2022-07-01", "2022-07-02", month_flags=True)
    rows = frame.collect()
    assert len(rows) == 1 and rows[0].July and not rows[0].June
    assert set(training.FEATURES) <= set(frame.columns)
    first, second = training.split_by_time(fact, "timestamp_MTN", [("2022-07-01", "2022-07-01 02:00:00"), ("2022-07-01 01:00:00", "2022-07-03")])
    assert (first.count(), second.count()) == (1, 1)


def history(spark, days=120):
    df = spark.range(days * 24).select(
        F.col("id"), (F.lit("2022-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ds")
    )
    temp = 50 + 20 * F.sin(F.col("id") / 24 * 0.3)
    return training.make_features(df.withColumn("temp_F", temp).withColumn("y", 4000 + 3 * temp + 10 * F.hour("ds")), "ds")


def test_run_log_best_run_and_stored_model(spark, tmp_path):
    root = str(tmp_path)
    day = timedelta(days=1)
    plan = dict(horizon=day, period=10 * day, initial=60 * day)
    rows = history(spark)
    best = training.train_run(rows, "ds", "y", "good", root, ["temp_F", "hour"], params={"note": 1}, **plan)
    training.train_run(rows, "ds", "y", "poor", root, ["temp_F"], **plan)
    runs = training.read_runs(spark, f"{root}/runs")
    assert runs.count() == 2
    found = training.best_run(runs).first()
    assert found.run_id == "good" and found.rmse == pytest.approx(0, abs=1e-6)
    logged = runs.filter("run_id = 'good'").first()
    assert logged.params["note"] == "1" and logged.params["features"] == "['temp_F', 'hour']"
    assert {"mse", "rmse", "mae", "mape", "mdape", "smape", "train_duration_minutes", "cv_duration_minutes"} <= set(logged.metrics)
    assert training.load_model(spark, f"{root}/models", "good") == best


def test_batch_prediction_is_point_in_time_and_hourly(spark):
    start, rows = D(2022, 7, 15, 6), []
    for h in range(-6, 24, 3):
        valid = start + timedelta(hours=h)
        rows.append((valid, -104.6, 39.8, 60 + h, start - timedelta(hours=20)))
        rows.append((valid, -104.6, 39.8, 70 + h, start - timedelta(hours=1)))
        rows.append((valid, -104.6, 39.8, 70 + h, start - timedelta(hours=1)))
        rows.append((valid, -104.6, 39.8, 99, start + timedelta(hours=1)))
    forecasts = spark.createDataFrame(rows, "forecast_time timestamp_ntz, lon double, lat double, temp_F long, creation_time timestamp_ntz")
    model = regression.LinearModel(("temp_F", "hour"), (2.0, 1.0), 100.0)
    got = prediction.batch_predict(forecasts, model, "run", "2022-07-15", "2022-07-15 07:00:00")
    made = got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("energy_timestamp_mtn", "prediction_start_date")})
    out = made.orderBy("energy_timestamp_mtn").collect()
    assert [r.energy_timestamp_mtn for r in out] == [start + timedelta(hours=h) for h in range(22)]
    assert [r.temp_f_forecast for r in out] == pytest.approx([70.0 + h for h in range(22)])
    assert [r.predicted_energy_demand for r in out] == pytest.approx([240.0 + 3 * h for h in range(22)])
    assert out[0].prediction_start_date == start and out[0].model_version == "run"
