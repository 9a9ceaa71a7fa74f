"""Vector columns as rows of doubles in bytes, and cells of query and candidate blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vector: Column, zero: bool) -> Column:
    """Whether a vector takes part: no null, no empty one, only finite components.

    ``zero`` tells whether a vector of zeros does.
    """
    good = F.size(vector) > 0
    good &= F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return good if zero else good & F.exists(vector, lambda x: x != 0)


def packed(df: DataFrame, id_col: str, vector: Column, zero: bool) -> DataFrame:
    """id, dim and vec (bytes of doubles) of the rows that take part; rows without an id do not."""
    from loadvane.session import ship_package

    ship_package(df.sparkSession)
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("vec", T.BinaryType())]
    )

    def run(frames):
        for frame in frames:
            vec = [np.asarray(v, np.float64) for v in frame["vec"]]
            yield pd.DataFrame({"id": frame["id"], "dim": [len(v) for v in vec], "vec": [v.tobytes() for v in vec]})

    chosen = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("vec")
    )
    return chosen.where(F.coalesce(usable(F.col("vec"), zero), F.lit(False))).mapInPandas(run, schema)


def matrix(column) -> np.ndarray:
    """Rows of doubles of equal length."""
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def sample(rows: DataFrame, size: int) -> pd.DataFrame:
    """At most ``size`` rows in the order of a hash of the id; always the same for a table."""
    return rows.orderBy(F.xxhash64("id"), "id").limit(size).toPandas()


def best(found: DataFrame, k: int) -> DataFrame:
    """Per query the k highest scores, ties to the smaller id, with their rank from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
