"""Tables whose ranges are replaced as a whole, visible all at once.

A table is a folder with ``data/`` and ``manifest/``. Each replacement writes its rows to a new
data folder and then one small manifest file that names the folder and the closed range of the
key it stands for. A row counts if no later manifest's range holds its key, so readers see either
none or all of a replacement, also of rows that are no longer there, and a replacement that breaks
off before its manifest changes nothing.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def manifests(spark: SparkSession, root: str) -> list[dict]:
    """The replacements so far, oldest first; one row each comes to the driver."""
    store, where = _files(spark, f"{root}/manifest")
    if not store.exists(where):
        return []
    rows = spark.read.text(f"{root}/manifest", wholetext=True).filter(F.length("value") > 0).collect()
    return sorted((json.loads(r["value"]) for r in rows), key=lambda m: m["version"])


def replace_range(df: DataFrame, root: str, key: str, low: str, high: str) -> int:
    """Put ``df`` in place of all rows with ``low <= key <= high``; returns the new version.

    Rows of ``df`` outside the range are an error. Of two replacements at the same time the one
    that comes second with its manifest fails and has to run again.
    """
    spark = df.sparkSession
    known = manifests(spark, root)
    version = known[-1]["version"] + 1 if known else 0
    folder = f"data/{version:08d}-{uuid.uuid4().hex}"
    outside = F.raise_error(F.concat(F.lit(f"{key} outside the replaced range: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    checked = F.when(F.col(key).between(low, high), F.col(key)).otherwise(outside.cast(df.schema[key].dataType))
    df.withColumn(key, checked).write.parquet(f"{root}/{folder}")
    entry = {"version": version, "folder": folder, "low": low, "high": high}
    store, where = _files(spark, f"{root}/manifest/{version:08d}.json")
    out = store.create(where, False)  # fails if the version is there
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    return version


def read_versions(spark: SparkSession, root: str, schema: T.StructType, key: str, version: int | None = None) -> DataFrame:
    """The table as of a version (default: now); ranges that a later one covers are not opened."""
    known = [m for m in manifests(spark, root) if version is None or m["version"] <= version]

    def within(m: dict) -> Column:
        return F.col(key).between(m["low"], m["high"])

    parts = [spark.createDataFrame([], schema)]
    for at, m in enumerate(known):
        later = known[at + 1 :]
        if any(n["low"] <= m["low"] and m["high"] <= n["high"] for n in later):
            continue
        rows = spark.read.schema(schema).parquet(f"{root}/{m['folder']}")
        # only ranges that meet this one are tested
        hidden = [within(n) for n in later if n["low"] <= m["high"] and m["low"] <= n["high"]]
        parts.append(rows.filter(~reduce(Column.__or__, hidden)) if hidden else rows)
    return reduce(DataFrame.unionByName, parts)
