"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadvane.session import fresh_dir

#: White space and words of a plain word count, fixed by the contract of the queries.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the stored copy.

    The copy cuts the lineage, so lost executors do not repeat the work before it.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column of that name exists in any case."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def octets(text: Column) -> Column:
    """Bytes of a text in UTF-8, none for null."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def ascii_lower(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def qualified(spark: SparkSession, path: str) -> str:
    """A folder with the file system that Spark finds it in; for the driver only."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


# Names that Hadoop gives to file systems which Arrow knows under others.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}


def shared_uri(uri: str) -> tuple[object, str]:
    """A file system and the path in it for a folder named by ``qualified``."""
    from pyarrow import fs

    scheme, found, rest = uri.partition(":")
    if not found or "/" in scheme:
        raise ValueError(f"without a scheme it is not known which file system holds {uri}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


_RESIDENT: dict[Hashable, Any] = {}


def resident(key: Hashable, build: Callable[[], Any]) -> Any:
    """A large object that a worker keeps between tasks, such as a vocabulary.

    A worker holds one at a time: Spark goes on with the same workers from operator to
    operator, and what the last one needed would stay beside what this one does.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = build()
    return _RESIDENT[key]
