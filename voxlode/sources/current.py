"""A list that is replaced category by category.

Rows lie in folders by category; a manifest says which folder holds each category of a version, and one pointer names the current version.  A
new version writes only the categories that changed and takes the other entries over, so their files stay as they are.  Readers open one
manifest, whatever the number of versions.  Until the pointer moves the old version is the list; what a cut-off writer left is named by no
manifest.  Manifests hold one entry per category.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .published import publish, published


def _manifest(path: str, version: str) -> str:
    return f"{path}/manifests/{version}.json"


def current_version(spark: SparkSession, path: str) -> str | None:
    found = published(spark, f"{path}/current.json")
    return found["version"] if found else None


def manifest_of(spark: SparkSession, path: str, version: str | None = None) -> dict | None:
    """The manifest of ``version``, by default the current one; None where there is none."""
    version = version or current_version(spark, path)
    return published(spark, _manifest(path, version)) if version else None


def read_list(spark: SparkSession, path: str, version: str | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """Rows of a version; with ``only``, of these categories alone."""
    found = manifest_of(spark, path, version)
    if found is None:
        raise ValueError(f"nothing is published at {path}" + (f" as {version}" if version else ""))
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    folders: dict[str, list[str | None]] = {}
    for category, folder in found["categories"]:
        if only is None or category in only:
            folders.setdefault(folder, []).append(category)
    out = spark.createDataFrame([], schema)
    by = F.col(found["by"])
    for folder, categories in sorted(folders.items()):
        named = by.isin([c for c in categories if c is not None])
        rows = spark.read.schema(schema).parquet(folder).filter(named | by.isNull() if None in categories else named)
        out = out.unionByName(rows.select(schema.fieldNames()))
    return out


def write_list(rows: DataFrame, path: str, version: str, by: str = "category", touched: Sequence[str] | None = None, base: str | None = None) -> None:
    """Publish ``version``: ``rows`` hold the categories ``touched`` (all by default), the other ones come from ``base`` (by default the current version)."""
    spark = rows.sparkSession
    before = manifest_of(spark, path, base) if touched is not None else None
    schema = T.StructType.fromJson(json.loads(before["schema"])) if before else rows.schema
    if dict(rows.dtypes) != {f.name: f.dataType.simpleString() for f in schema}:
        raise ValueError("the columns of a list don't change from version to version")
    folder = f"{path}/data/{version}-{uuid.uuid4().hex}"
    rows.select(schema.fieldNames()).write.partitionBy(by).parquet(folder)
    there = [r[0] for r in spark.read.schema(schema).parquet(folder).select(by).distinct().collect()]
    kept = [e for e in before["categories"] if e[0] not in touched] if before else []
    content = {"version": version, "before": base or current_version(spark, path), "by": by, "schema": schema.json(), "categories": kept + [[c, folder] for c in there]}
    publish(spark, _manifest(path, version), content)
    publish(spark, f"{path}/current.json", {"version": version})
