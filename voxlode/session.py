"""Session helpers: reliable checkpoints, shared scratch paths, sizing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables.

    The cluster's ``spark.checkpoint.dir`` wins.  Only a session without one (a local
    test) gets a fresh folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_SCRATCH[app]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per session, for clusters where it is not installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="voxlode-")
    archive = os.path.realpath(os.path.join(folder, f"{package.name}.zip"))
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and return it without its lineage."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared scratch folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to scratch storage and read back, and its folder, which :func:`discard` deletes when nothing reads it any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`stored`; Spark drops the shuffle files of plans that are no longer held with the next collection."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
