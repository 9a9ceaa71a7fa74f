"""Session set-up and the few run-time checks that need a session."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "loadvane", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session in UTC with adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no call-site capture per column: it takes most of the time to build wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: wall-clock columns are NTZ, instants are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with the machine, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # "local-cluster" has executors of its own
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="loadvane-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an expensive intermediate to the shared folder and go on from the stored copy.

    Later steps read it several times without repeating its lineage, plan with its real
    size, and survive lost executors.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as ``--py-files`` would."""
    context = spark.sparkContext
    if any(name.startswith("loadvane-") for name in map(os.path.basename, context._python_includes)):
        return
    source = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="loadvane-code-"), f"loadvane-{uuid.uuid4().hex[:8]}"),
        "zip",
        os.path.dirname(source),
        os.path.basename(source),
    )
    context.addPyFile(archive)
