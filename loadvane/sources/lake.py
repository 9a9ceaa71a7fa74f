"""Staged Parquet folders and published tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadvane import schemas
from loadvane.functions.columns import strict_cast

# kind of staged data: its schema and the columns its folders are keyed by
STAGED: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "demand_data": (schemas.DEMAND_DATA, ("series_id",)),
    "demand_metadata": (schemas.DEMAND_METADATA, ()),
    "weather_station": (schemas.STATION_OBSERVATIONS, ("year",)),
    "live_weather": (schemas.LIVE_WEATHER, ("landed",)),
    "weather_forecast": (schemas.WEATHER_FORECAST, ()),
    "energy_demand_forecasts": (schemas.DEMAND_PREDICTIONS, ()),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast to its types; a missing column or a bad value is an error."""
    return df.select(*_typed(df, schema))


def _typed(df: DataFrame, schema: T.StructType) -> list[Column]:
    found = {f.name.lower(): f.dataType for f in df.schema}
    return [
        (F.col(f.name) if found.get(f.name.lower()) == f.dataType else strict_cast(f.name, f.dataType)).alias(f.name)
        for f in schema
    ]


def write_typed(
    df: DataFrame, schema: T.StructType, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Schema-enforced Parquet; with partitions, ``overwrite`` replaces only those present in ``df``."""
    extra = [F.col(c) for c in partition_by if c not in schema.fieldNames()]
    typed = df.select(*_typed(df, schema), *extra)
    writer = typed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def stage(df: DataFrame, kind: str, root: str, mode: str = "overwrite") -> str:
    """Write staged data of a known kind in its folder layout."""
    schema, keys = STAGED[kind]
    path = f"{root}/staged/{kind}"
    write_typed(df, schema, path, keys, mode)
    return path


def scan_staged(
    spark: SparkSession, kind: str, root: str, partition_types: dict[str, T.DataType] | None = None
) -> DataFrame:
    """All files of a staged kind under its declared schema; filters on the folder keys prune folders."""
    schema, keys = STAGED[kind]
    types = {"year": T.IntegerType(), **(partition_types or {})}
    added = [T.StructField(k, types.get(k, T.StringType())) for k in keys if k not in schema.fieldNames()]
    return spark.read.schema(T.StructType([*schema.fields, *added])).parquet(f"{root}/staged/{kind}")


def publish_overwrite(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a table by the result of a query."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def publish_append(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append to a table, creating it if it is absent; nothing is deduplicated."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def materialize(build: Callable[[], DataFrame], name: str, as_: str = "view", path: str | None = None) -> DataFrame:
    """Build a model and store it as a table or register it as a view."""
    df = build()
    if as_ == "table":
        publish_overwrite(df, name, path)
    elif as_ == "view":
        df.createOrReplaceTempView(name)
    else:
        raise ValueError(f"as_ must be 'table' or 'view', not {as_!r}")
    return df.sparkSession.table(name)
