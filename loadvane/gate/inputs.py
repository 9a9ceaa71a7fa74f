"""Domain tables as projections of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadvane.functions.timefn import ntz
from loadvane.operators.grid import LambertGrid

GRID = LambertGrid(
    nx=10, ny=10, dx=200_000.0, dy=200_000.0, lon0=-120.0, lat0=25.0, radius=6_371_200.0,
    central_lat=25.0, central_lon=-95.0, secant_lat_1=25.0, secant_lat_2=40.0,
)
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


class Tables:
    """The test tables of one folder and the domain tables over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        """Events with the integer ``k`` of their properties."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.read("events").withColumn("k", k)

    # demand

    def demand(self) -> DataFrame:
        return self.read("events").select(F.col("event_type").alias("series_id"), F.col("ts").alias("timestamp"), "value")

    def demand_hourly(self) -> DataFrame:
        hour = ntz(F.date_trunc("hour", "timestamp"))
        return (
            self.demand()
            .groupBy("series_id", hour.alias("timestamp"))
            .agg(F.round(F.sum("value"), 4).alias("value"))
        )

    def metadata(self) -> DataFrame:
        return (
            self.read("events")
            .groupBy(F.col("event_type").alias("series_id"))
            .agg(F.date_format(F.max("ts"), ISO_SECONDS).alias("updated"))
            .select("series_id", F.lit("megawatthours").alias("units"), F.upper("series_id").alias("name"), "updated")
        )

    def shipments(self) -> DataFrame:
        """A long value series over all years, months and hours, with a measured companion."""
        at = F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
        return self.read("lineitem").select(
            at.alias("ts"), F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("temp_F")
        )

    def daily_demand(self) -> DataFrame:
        return (
            self.read("orders")
            .groupBy(F.col("o_orderdate").alias("ds"))
            .agg(
                F.round(F.sum("o_totalprice") / 1000, 3).alias("y"),
                F.count(F.lit(1)).cast("double").alias("temp_F"),
            )
        )

    # weather

    def station_observations(self) -> DataFrame:
        e = self.events
        user = F.col("user_id").cast("string")
        flag = (F.floor(F.col("event_id") / 2) % 10).cast("string")
        return e.select(
            F.concat(F.lpad(user, 6, "0"), F.lpad((F.col("user_id") % 100).cast("string"), 5, "0")).alias("STATION"),
            F.concat(F.lit("STATION "), user).alias("NAME"),
            F.date_format("ts", ISO_SECONDS).alias("DATE"),
            F.when(F.col("k") != 50, F.col("k") - 20.0).alias("temperature_degC"),
            (F.col("k") - 25.0).alias("dew_point_degC"),
            flag.alias("temperature_QC"),
            flag.alias("dew_point_QC"),
        )

    def yearly_observations(self) -> DataFrame:
        """Station observations over several years, with their ``year``."""
        key = F.col("o_orderkey")
        flag = (key % 10).cast("string")
        return self.read("orders").select(
            F.lpad(F.col("o_custkey").cast("string"), 11, "0").alias("STATION"),
            F.col("o_orderpriority").alias("NAME"),
            F.date_format("o_orderdate", ISO_SECONDS).alias("DATE"),
            (key % 60 - 20).cast("double").alias("temperature_degC"),
            (key % 50 - 25).cast("double").alias("dew_point_degC"),
            flag.alias("temperature_QC"),
            flag.alias("dew_point_QC"),
            F.year("o_orderdate").alias("year"),
        )

    def stations(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.read("supplier").select(
            F.lpad(key.cast("string"), 6, "0").alias("USAF"),
            F.lpad((key % 100).cast("string"), 5, "0").alias("WBAN"),
            F.concat("s_name", F.when(key % 3 == 0, " AIRPORT").otherwise(" FIELD")).alias("STATION NAME"),
            F.when(F.col("s_nationkey") % 2 == 0, "CO").otherwise("WY").alias("STATE"),
            ((key % 40) / 10.0 + 37).alias("LAT"),
            ((key % 70) / 10.0 - 109).alias("LON"),
            F.date_add(F.lit("1990-01-01").cast("date"), (key % 1000).cast("int")).alias("BEGIN"),
            F.date_add(F.lit("2021-06-01").cast("date"), (key * 7 % 600).cast("int")).alias("END"),
        )

    def live_observations(self) -> DataFrame:
        k, place = F.col("k"), (F.col("user_id") % 10) / 10.0
        return self.events.select(
            (k - 20.0).alias("temp"),
            (k - 22.0).alias("feels_like"),
            (k - 24.0).alias("temp_min"),
            (k - 18.0).alias("temp_max"),
            (k + 1000.0).alias("pressure"),
            k.cast("double").alias("humidity"),
            ntz(F.date_trunc("second", "ts")).alias("timestamp"),
            (F.lit(-104.0) - place).alias("lon"),
            (F.lit(39.0) + place).alias("lat"),
        )

    def forecasts(self) -> DataFrame:
        three_hours = ntz(F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 10_800) * 10_800))
        place = (F.col("user_id") % 4).cast("double")
        return self.events.select(
            three_hours.alias("forecast_time"),
            (F.lit(-104.0) - place).alias("lon"),
            (F.lit(39.0) + place).alias("lat"),
            F.col("k").cast("long").alias("temp_F"),
            (F.col("ts") - F.make_dt_interval(hours=(F.col("event_id") % 72).cast("int"))).alias("creation_time"),
        )

    def newest_forecast(self) -> DataFrame:
        """One value per place and valid time: the last one issued."""
        newest = F.max(F.struct("creation_time", "temp_F"))["temp_F"]
        return self.forecasts().groupBy("lat", "lon", "forecast_time").agg(newest.cast("double").alias("temp_F"))

    # predictions

    def predictions(self) -> DataFrame:
        t = F.col("timestamp")
        parity = F.day(t) % 2
        start = ntz(F.date_trunc("day", t)) - F.make_dt_interval(days=parity)
        return self.demand_hourly().select(
            (t + F.expr("INTERVAL '5' HOUR")).alias("energy_timestamp_mtn"),
            F.round(F.col("value") * 0.9 + F.hour(t), 4).alias("predicted_energy_demand"),
            (F.hour(t) + 20.0).alias("temp_f_forecast"),
            F.concat(F.lit("v"), parity.cast("string")).alias("model_version"),
            start.alias("prediction_start_date"),
            (start + F.expr("INTERVAL '6' HOUR")).alias("prediction_creation_date"),
        )

    # grids

    def grid_messages(self) -> DataFrame:
        """One message per hundred parts: their sizes in key order, an hour apart."""
        cells = GRID.nx * GRID.ny
        message = F.floor(F.col("p_partkey") / cells).cast("int")
        ordered = F.array_sort(F.collect_list(F.struct("p_partkey", "p_size")))
        return (
            self.read("part")
            .groupBy(message.alias("message"))
            .agg(F.transform(ordered, lambda c: c["p_size"].cast("double")).alias("values"))
            .select(
                (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("message"))).alias("valid_time"),
                "values",
            )
        )

    def customer_points(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.read("customer").select(
            F.col("c_custkey").alias("point"),
            ((key % 600) / 10.0 - 125).alias("lon"),
            ((key % 250) / 10.0 + 24).alias("lat"),
        )

    def nation_points(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.read("nation").select(
            key.alias("point"), (key * 1.7 - 125).alias("lon"), (key * 0.9 + 22).alias("lat")
        )

    # documents

    def demand_documents(self) -> DataFrame:
        e = self.read("events")
        hour = F.date_format("ts", "yyyyMMdd'T'HH'Z'")
        following = F.date_format(F.col("ts") + F.expr("INTERVAL '1' HOUR"), "yyyyMMdd'T'HH'Z'")
        return e.select(
            F.concat(
                F.lit('{"series": [{"series_id": "EBA.'), F.upper("event_type"),
                F.lit('.D.H", "name": "'), F.col("event_type"),
                F.lit('", "units": "megawatthours", "updated": "'), F.date_format("ts", ISO_SECONDS),
                F.lit('", "description": "user '), F.col("user_id").cast("string"),
                F.lit('", "data": [["'), hour, F.lit('", '), F.col("value").cast("string"),
                F.lit('], ["'), following, F.lit('", null]]}]}'),
            ).alias("value")
        )

    def station_lines(self) -> DataFrame:
        o = self.station_observations()
        return o.select(
            F.concat_ws(
                ",",
                "STATION",
                F.concat(F.lit('"'), F.col("NAME"), F.lit(', CO US"')),
                "DATE",
                F.concat(F.lit('"'), scaled_text("temperature_degC", "temperature_QC"), F.lit('"')),
                F.concat(F.lit('"'), scaled_text("dew_point_degC", "dew_point_QC"), F.lit('"')),
            ).alias("value")
        )

    def live_documents(self) -> DataFrame:
        o = self.live_observations()
        return o.select(
            F.to_json(
                F.struct(
                    F.struct("lon", "lat").alias("coord"),
                    F.lit("stations").alias("base"),
                    F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("dt"),
                    F.struct(
                        F.col("temp").cast("int").alias("temp"), "feels_like", "temp_min", "temp_max",
                        "pressure", "humidity", F.col("pressure").alias("sea_level"),
                    ).alias("main"),
                )
            ).alias("value"),
            "timestamp",
        )

    def forecast_documents(self) -> DataFrame:
        f = self.forecasts()
        iso = lambda c: F.date_format(c, ISO_SECONDS)
        later = F.col("forecast_time") + F.expr("INTERVAL '3' HOUR")
        return f.select(
            F.concat(
                F.lit("<dwml><head><product><creation-date>"), iso("creation_time"),
                F.lit('Z</creation-date></product></head><data><location><point latitude="'),
                F.col("lat").cast("string"), F.lit('" longitude="'), F.col("lon").cast("string"),
                F.lit('"/></location><time-layout><start-valid-time>'), iso("forecast_time"),
                F.lit("-06:00</start-valid-time><start-valid-time>"), iso(later),
                F.lit("-06:00</start-valid-time></time-layout><parameters><temperature><value>"),
                F.col("temp_F").cast("string"), F.lit("</value><value>"), (F.col("temp_F") + 1).cast("string"),
                F.lit("</value></temperature></parameters></data></dwml>"),
            ).alias("value")
        )


def scaled_text(value: str, flag: str):
    """A value and its flag as the station format writes them: ``+0123,1``; missing is ``+9999,9``."""
    tenths = (F.col(value) * 10).cast("int")
    text = F.concat(F.when(tenths < 0, "-").otherwise("+"), F.lpad(F.abs(tenths).cast("string"), 4, "0"), F.lit(","), F.col(flag))
    return F.coalesce(text, F.lit("+9999,9"))
