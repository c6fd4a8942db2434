"""Session settings, shared scratch space and materialised cut points."""

from __future__ import annotations

import io
import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are planned for.

    Adaptive execution picks the join side to broadcast from measured sizes, merges small
    shuffle partitions and splits skewed ones. Forcing the skew split accepts one more
    shuffle behind a split join in exchange for no oversized task.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Only a local session may fall back on a temporary folder: on a cluster such a folder
    would exist on one machine and its loss would take the tables along.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        configured = context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="basketry-")
        context.setCheckpointDir(configured)
    return f"{configured.rstrip('/')}/basketry-{context.applicationId}"


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers of the session, once. Spark's file server sends the archive
    to every executor, so they need neither the driver's folder nor its path settings."""
    with _shipping:
        if spark.sparkContext.applicationId not in _shipped:
            _send(spark)
            _shipped.add(spark.sparkContext.applicationId)


def _send(spark: SparkSession) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = os.path.join(tempfile.mkdtemp(prefix="basketry-"), "basketry_workers.zip")
    with open(path, "wb") as out:
        out.write(held.getvalue())
    spark.sparkContext.addPyFile(path)


def materialise(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where two passes have to see the same rows in the same places. A table survives
    the loss of executors, keeps column pruning and gives the optimizer its true size.
    """
    path = f"{scratch_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(file_system.exists(hadoop_path))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path``; a metadata call."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(file_system.getContentSummary(hadoop_path).getLength())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; empty when it does not exist."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in file_system.listStatus(hadoop_path) if s.isDirectory())
