"""Session building and durable intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def build_session(name: str = "folioflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators are tuned for; given settings win."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a local one where that is unset.

    A local folder is chosen only when the master is local; on a cluster the
    setting is required, as a machine-local folder would not be readable there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = os.path.join(tempfile.gettempdir(), f"folioflow-{os.getuid()}")
    return f"file://{local}"


def stage(df: DataFrame, label: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def staged() -> int:
    """How many tables are staged; release_stages() takes it to keep those of earlier results."""
    return len(_written)


def release_stages(since: int = 0) -> None:
    """Delete the staged tables of this process, or those since a mark; a long session calls it when a result is written, and it is called at exit."""
    while len(_written) > since:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session is gone; its folder is cleaned with it
            continue


atexit.register(release_stages)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the parquet tables under root."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
