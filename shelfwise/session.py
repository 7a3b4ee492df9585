"""Session defaults for local work and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "shelfwise", cores: str | int = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks. On a cluster, use the session the cluster hands out instead."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("SHELFWISE_DRIVER_MEMORY", "12g"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that folder would exist on one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="shelfwise-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end whatever :func:`materialize` wrote inside.

    Results that are still to be read must be written, or collected, before the scope ends.
    """
    written: list[str] = []
    _scopes.append(written)
    try:
        yield
    finally:
        _scopes.remove(written)
        for path in written:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written to a path of :func:`scratch_path`."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder, deleted with the scope that it is asked for in."""
    path = f"{shared_folder(spark)}/shelfwise/{spark.sparkContext.applicationId}/{name}"
    for written in _scopes:
        written.append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably (a lost executor loses nothing), fixes the outcome of anything order-dependent, and
    gives later joins a real size to plan with.
    """
    spark = df.sparkSession
    path = scratch_path(spark, uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
