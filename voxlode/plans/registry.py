"""Registry of runnable queries, each with its inventory ids and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: Runner
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register ``fn(spark, sf_dir)`` under ``name``; ``ids`` are the inventory rows it covers."""

    def wrap(fn: Runner) -> Runner:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Day labels and cutoffs are defined on the UTC time line.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Query(name, ids, run, sql)
        return fn

    return wrap
