"""Outputs: category envelopes and dated snapshots."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "snapshot"


def write_envelope(rows: DataFrame, header: DataFrame, path: str, category: str = "category") -> None:
    """Per-category output: ``<path>/header`` with one JSON object of counters and settings per category, and
    ``<path>/rows/<category>=...`` with one JSON object per opportunity.

    The reference shape nests all rows in one object; here they stay lines of partitioned files, so a
    category of any size is written by many tasks and read with partition pruning.
    """
    header.write.mode("errorifexists").json(f"{path}/header")
    rows.write.mode("errorifexists").partitionBy(category).json(f"{path}/rows")


def envelope_header(rows: DataFrame, category: str, as_of: str, weights: dict[str, float]) -> DataFrame:
    """Counters and settings of each category."""
    setting = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])
    return rows.groupBy(category).agg(
        F.count(F.lit(1)).alias("final_demands"), F.sum("mention_count").alias("mentions")
    ).withColumns({"analysis_date": F.lit(as_of), "weights": setting})


def write_snapshot(df: DataFrame, path: str, day: str) -> None:
    """Write a dated partition.  Earlier snapshots stay as they are, and the data may come from them."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"not a day: {day}")
    df.write.mode("errorifexists").parquet(f"{path}/{SNAPSHOT}={day}")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/{SNAPSHOT}=*").withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("string"))


def snapshot_as_of(snapshots: DataFrame, day: str) -> DataFrame:
    """Rows of the snapshot of ``day``, else of the latest one at all, with ``status`` ok or stale.

    The snapshot is chosen from the partition values; only its files are scanned.
    """
    days = snapshots.select(SNAPSHOT).distinct()
    pick = days.agg(F.coalesce(F.max(F.when(F.col(SNAPSHOT) == day, F.col(SNAPSHOT))), F.max(SNAPSHOT))).scalar()
    status = F.when(F.col(SNAPSHOT) == day, "ok").otherwise("stale")
    return snapshots.filter(F.col(SNAPSHOT) == pick).withColumn("status", status)


def snapshot_up_to(snapshots: DataFrame, day: str) -> DataFrame:
    """Rows of the latest snapshot not after ``day``."""
    pick = snapshots.filter(F.col(SNAPSHOT) <= day).agg(F.max(SNAPSHOT)).scalar()
    return snapshots.filter(F.col(SNAPSHOT) == pick)
