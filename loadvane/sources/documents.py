"""Landed JSON, CSV and XML documents to typed rows.

Each ``parse_*`` works on a column of document texts; each ``read_*`` puts files under it. A
document that does not parse, or a time or value in it that does not, stops the job: it would
otherwise look like a gap in the data.
"""

from __future__ import annotations

import csv
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane import schemas
from loadvane.functions.columns import normalize_series_id, split_scaled, strict_cast
from loadvane.functions.timefn import parse_compact_hour, parse_epoch, parse_iso
from loadvane.sources.versions import replace_range

# Fixed value: the hour stamp in landed file names.
HOUR_STAMP = r"(\d{4}-\d{2}-\d{2}-\d{2})"


def _documents(spark: SparkSession, path: str | list[str], wholetext: bool = True) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=wholetext)


# Demand series JSON


def _required(value: Column, what: str, text: Column | str) -> Column:
    """``value``, or an error that shows the begin of the text it should have come from."""
    shown = F.substring(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("null")), 1, 200)
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), shown)))


def _series(df: DataFrame, text: str) -> DataFrame:
    document = F.from_json(text, schemas.DEMAND_DOCUMENT, {"mode": "FAILFAST"})
    return df.select(F.explode(_required(document["series"], "not a demand document", text)).alias("s"), text)


def parse_demand_values(df: DataFrame, text: str = "value") -> DataFrame:
    """``timestamp, value, series_id``: one row per reading; missing readings stay as null."""
    return (
        _series(df, text)
        .select(normalize_series_id("s.series_id").alias("series_id"), F.explode("s.data").alias("d"))
        .select(
            _required(parse_compact_hour(F.get("d", F.lit(0))), "not an hour", F.get("d", F.lit(0))).alias("timestamp"),
            strict_cast(F.get("d", F.lit(1)), "double").alias("value"),
            "series_id",
        )
    )


def parse_demand_metadata(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per series: everything but its readings.

    Fields beyond the named ones are in ``others`` as text, null if there are none.
    """
    known = F.array(*map(F.lit, ("series_id", "name", "units", "updated", "data")))
    plain = F.from_json(text, "struct<series: array<map<string, string>>>", {"mode": "FAILFAST"})["series"]
    others = F.map_filter(F.get(plain, F.col("at")), lambda k, v: ~F.array_contains(known, k))
    document = F.from_json(text, schemas.DEMAND_DOCUMENT, {"mode": "FAILFAST"})
    return df.select(
        F.posexplode(_required(document["series"], "not a demand document", text)).alias("at", "s"), text
    ).select(
        normalize_series_id("s.series_id").alias("series_id"),
        "s.name",
        "s.units",
        "s.updated",
        F.when(F.size(others) > 0, others).alias("others"),
    )


def read_demand_values(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_demand_values(_documents(spark, path))


def read_demand_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_demand_metadata(_documents(spark, path))


# Station observations and stations

# The columns of a station file that are used.
STATION_COLUMNS = ("STATION", "NAME", "DATE", "TMP", "DEW")


def typed_station_rows(df: DataFrame) -> DataFrame:
    """Split the ``"value,flag"`` fields ``TMP`` and ``DEW`` of station rows."""
    temperature, temperature_flag = split_scaled("TMP")
    dew_point, dew_point_flag = split_scaled("DEW")
    return df.select(
        F.col("STATION").cast("string").alias("STATION"),
        "NAME",
        "DATE",
        temperature.alias("temperature_degC"),
        dew_point.alias("dew_point_degC"),
        temperature_flag.alias("temperature_QC"),
        dew_point_flag.alias("dew_point_QC"),
    )


def parse_station_lines(df: DataFrame, text: str = "value") -> DataFrame:
    """Station CSV lines without a header, columns as in ``schemas.STATION_LINE``."""
    line = F.from_csv(F.col(text), schemas.STATION_LINE.simpleString()[7:-1].replace(":", " "), {"quote": '"'})
    return typed_station_rows(df.select(line.alias("r")).select("r.*"))


def read_station_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Station files with a header; columns are found by name in each file.

    Files differ in their optional columns. They are grouped by their first line, and each
    group is read under its own header, so the driver holds one row per header and file.
    A file whose first line lacks a needed column is an error; an empty file has no rows.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # grows with the lines of a block, so the least is the first line
        F.monotonically_increasing_id().alias("line"),
    )
    first = lines.where(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "line").alias("header"))
    groups = (
        first.groupBy(F.regexp_replace("header", "^\ufeff|\\s+$", "").alias("header"))
        .agg(F.array_sort(F.collect_list("file")).alias("files"))
        .orderBy("header")
        .collect()
    )
    tables = [spark.createDataFrame([], schemas.STATION_OBSERVATIONS)]
    for group in groups:
        names = next(csv.reader([group["header"]]), [])
        lacking = [c for c in STATION_COLUMNS if c not in names]
        if lacking:
            raise ValueError(f"no column {', '.join(lacking)} in the first line of {', '.join(group['files'][:5])}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(group["files"])
        tables.append(typed_station_rows(rows))
    return reduce(DataFrame.unionByName, tables)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """The station table; both parts of the key stay text, so leading zeros survive."""
    return (
        spark.read.schema(schemas.STATION_SEED)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


# Live observation JSON


def parse_live_weather(df: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nine typed columns per observation; fields beyond them are ignored."""
    document = df.select(F.from_json(text, schemas.LIVE_DOCUMENT, {"mode": "FAILFAST"}).alias("d"), F.col(text), *keep)
    return document.select(
        "d.main.*",
        parse_epoch(_required(F.col("d.dt"), "not a live document", text)).alias("timestamp"),
        "d.coord.lon",
        "d.coord.lat",
        *keep,
    )


def read_live_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_live_weather(_documents(spark, path))


def reprocess_live_weather(
    spark: SparkSession, path: str, start: datetime, end: datetime, wholetext: bool = True
) -> DataFrame:
    """Re-extract the raw documents landed in the closed range of hours under today's schema.

    The hour stamp is part of each file's path below ``path``, so other files are not opened.
    ``wholetext=False`` reads one document per line.
    """
    # a stamp in the name of the root folder itself does not count
    below = F.substring_index(F.col("_metadata.file_path"), "/" + path.rstrip("/").rpartition("/")[2] + "/", -1)
    stamp = F.regexp_extract(below, HOUR_STAMP, 1)
    raw = _documents(spark, path, wholetext).select("value", stamp.alias("landed"))
    first, last = (moment.strftime("%Y-%m-%d-%H") for moment in (start, end))
    return parse_live_weather(raw.filter(F.col("landed").between(first, last)), keep=("landed",))


def rewrite_live_weather(
    spark: SparkSession, path: str, root: str, start: datetime, end: datetime, wholetext: bool = True
) -> int:
    """Put the re-extracted hours from ``start`` to ``end`` in place of the table's rows of them.

    The table under ``root`` is one of ``sources.versions``: the hours change all at once, and
    the same rewrite again changes nothing. Returns the version.
    """
    first, last = (moment.strftime("%Y-%m-%d-%H") for moment in (start, end))
    return replace_range(reprocess_live_weather(spark, path, start, end, wholetext), root, "landed", first, last)


# Point forecast XML


def parse_forecast_xml(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per valid time; unequal numbers of times and values stop the job."""
    document = F.from_xml(text, schemas.FORECAST_DOCUMENT, {"mode": "FAILFAST"})
    lists = df.select(document.alias("d")).select(
        F.flatten("d.data.time-layout.start-valid-time").alias("times"),
        F.flatten(F.flatten(F.transform("d.data.parameters", lambda p: p["temperature"]["value"]))).alias("temps"),
        F.element_at("d.data.location.point", -1).alias("point"),
        parse_iso(F.element_at("d.head.product.creation-date", -1)).alias("creation_time"),
    )
    paired = F.when(F.size("times") == F.size("temps"), F.arrays_zip("times", "temps")).otherwise(
        F.raise_error(F.lit("forecast document with unequal numbers of times and values"))
    )
    return lists.select("point", "creation_time", F.explode(paired).alias("pair")).select(
        parse_iso("pair.times").alias("forecast_time"),
        F.col("point._longitude").alias("lon"),
        F.col("point._latitude").alias("lat"),
        strict_cast("pair.temps", "long").alias("temp_F"),
        "creation_time",
    )


def read_forecast_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_forecast_xml(_documents(spark, path))
