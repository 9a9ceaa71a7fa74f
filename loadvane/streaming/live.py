"""Continuous landing of live weather observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadvane import schemas
from loadvane.sources.documents import parse_live_weather
from loadvane.sources.lake import conform

#: What tells observations apart.
OBSERVATION = ["lat", "lon", "timestamp"]


def one_per_observation(df: DataFrame) -> DataFrame:
    """Of the repeats of an observation that differ the one with the largest values, column by column.

    The order is total, so a batch that runs again keeps the same ones.
    """
    rest = [c for c in df.columns if c not in OBSERVATION]
    return df.groupBy(*OBSERVATION).agg(F.max(F.struct(*rest)).alias("kept")).select("kept.*", *OBSERVATION)


def live_observations(
    spark: SparkSession, raw: str, files_per_batch: int = 1000, wholetext: bool = True
) -> DataFrame:
    """Stream of typed observations from raw JSON files, repeats included.

    ``wholetext=False`` reads one document per line instead of one per file.
    """
    landed = (
        spark.readStream.format("text")
        .option("wholetext", str(wholetext).lower())
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(raw)
    )
    return conform(parse_live_weather(landed), schemas.LIVE_WEATHER)


def append_new(out: str):
    """A batch writer: observations whose place and time are not stored yet, however late.

    Rows go to folders by day and batch. A batch that runs again replaces what it wrote, and is
    compared with the other batches of the days it touches only, of which no more than the
    columns that tell observations apart are read.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = one_per_observation(batch).withColumn("day", F.to_date("timestamp"))
        days = [r["day"] for r in fresh.select("day").distinct().collect()]
        if not days:
            return
        if _exists(spark, out):
            stored = read_landed(spark, out).where(F.col("day").isin(days) & (F.col("batch") != number))
            same = [fresh[c].eqNullSafe(stored[c]) for c in ("day", *OBSERVATION)]
            fresh = fresh.join(stored, same, "left_anti")
        (
            fresh.withColumn("batch", F.lit(number).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch")
            .parquet(out)
        )

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_landed(spark: SparkSession, out: str) -> DataFrame:
    """Stored observations with the day and batch that they were landed under."""
    kept = T.StructType([*schemas.LIVE_WEATHER.fields, T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(kept).parquet(out)


def land_live_weather(
    spark: SparkSession, raw: str, out: str, checkpoint: str, wholetext: bool = True
) -> StreamingQuery:
    """Land every file so far exactly once, then stop; run again for later files."""
    return (
        live_observations(spark, raw, wholetext=wholetext)
        .writeStream.foreachBatch(append_new(out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
