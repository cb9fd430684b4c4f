"""Session defaults and reliable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tenderlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (AQE on, UTC, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster, or a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return os.path.join(tempfile.gettempdir(), "tenderlens")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed with the innermost ``scratch_scope`` around the call."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the written steps of the operators called inside; nothing else is touched.

    Operators return lazy tables that read those steps: write or collect the results inside the scope. Without a scope
    the steps stay until the owner of the shared folder clears it.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            store, target = file_system(spark, path)
            store.delete(target, True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Needed where later steps read the same rows several times, above all when all reads must see
    the same physical layout. The table is columnar, so each reader takes only its columns, and it
    outlives the executors that wrote it.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df))


def written(df: DataFrame) -> str:
    """The folder below the shared one that ``df`` has been written to."""
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path, compression="zstd")
    return path
