"""Incremental runs: newly landed rows, repeated deliveries, and the merge of a batch into the current list."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import parse_ts
from ..functions.text import col
from ..operators.similarity import nearest_match
from ..session import cut
from ..sources.current import manifest_of, read_list, write_list
from ..sources.sinks import SNAPSHOT


def landed_stream(spark: SparkSession, folder: str, schema: Any, fmt: str = "json", glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Stream over a folder of landed files; files already taken by the same checkpoint are skipped."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ingest_increment(
    stream: DataFrame, date: str, as_of: str, days: int, out: str, checkpoint: str, by: list[str] | None = None
) -> StreamingQuery:
    """Take what has landed since the last run, keep the last ``days`` days before ``as_of``, append it as Parquet.

    Stops when all available files are done; the file sink writes each batch exactly once.
    """
    cutoff = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))
    ts = F.col(date) if dict(stream.dtypes)[date].startswith("timestamp") else parse_ts(date)
    writer = stream.filter(ts >= cutoff).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    return writer.trigger(availableNow=True).start(out)


def dedupe_stream(stream: DataFrame, row_id: str, ts: str, late: str) -> DataFrame:
    """Drop rows whose id was already delivered; ids are remembered until the watermark passes."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([row_id])


def merge_increment(
    main: DataFrame,
    new: DataFrame,
    vec: str,
    today: str,
    t: float = 0.85,
    new_defaults: Mapping[str, Any] | None = None,
    infix: str = "_demand_new_",
) -> DataFrame:
    """Merge a batch of demands into the current list.

    ``main``: id, vec, category, mention_count, is_new, discovered_at, last_updated_at, ...;
    ``new``: category, ord (unique), size, vec and any other column of ``main``.  A new row joins its most similar
    main row of its category if the cosine is at least ``t``: the sizes are added and the date is set.  Others are
    appended, flagged as new.  New rows are compared with the old list only.
    """
    asks = new.select(F.col("ord").alias("_new"), vec, "category")
    olds = main.select(F.col("id").alias("_old"), vec, "category")
    # Matched rows and the others are both taken from it: the comparison runs once.
    match = cut(nearest_match(asks, olds, "_new", "_old", vec, t, by="category").select("_new", "_old"))
    hit = new.join(match.select(F.col("_new").alias("ord"), "_old"), "ord")
    grown = hit.groupBy("_old").agg(F.sum("size").alias("_add"))
    kept = (
        main.join(grown, main["id"] == grown["_old"], "left")
        .withColumns(
            {
                "mention_count": (F.coalesce("mention_count", F.lit(0)) + F.coalesce("_add", F.lit(0))).cast("bigint"),
                "last_updated_at": F.when(F.col("_add").isNotNull(), F.lit(today)).otherwise(F.col("last_updated_at")),
            }
        )
        .select(*main.columns)
    )
    fresh = new.join(match.select(F.col("_new").alias("ord")), "ord", "left_anti")
    known = set(new.columns)
    own = {
        "id": F.concat(F.col("category"), F.lit(f"{infix}{today}_"), F.col("ord").cast("string")),
        "mention_count": F.col("size").cast("bigint"),
        "is_new": F.lit(True),
        "discovered_at": F.lit(today),
        "last_updated_at": F.lit(None).cast("string"),
        "priority": F.lit("P1"),
    }
    defaults = {k: F.lit(v) for k, v in (new_defaults or {}).items()}

    def value(c: str) -> Column:
        if c in own:
            return own[c]
        if c in known:
            return F.coalesce(F.col(c), defaults[c]) if c in defaults else F.col(c)
        return defaults.get(c, F.lit(None))

    types = dict(main.dtypes)
    return kept.unionByName(fresh.select(*[value(c).cast(types[c]).alias(c) for c in main.columns]))


def expire_new(flag: Column | str, discovered: Column | str, as_of: str, days: int = 7) -> Column:
    """The flag, false once the discovery is older than ``days`` days or its date unreadable."""
    limit = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))
    known = F.coalesce(col(discovered), F.lit("")) != ""
    stale = F.when(known, F.coalesce(parse_ts(discovered) < limit, F.lit(True))).otherwise(F.lit(False))
    return F.coalesce(col(flag), F.lit(False)) & ~stale


def merge_stream(
    stream: DataFrame, path: str, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame], label: Callable[[int], str]
) -> StreamingQuery:
    """Merge each micro-batch into the snapshot before it and write a new one.

    ``merge(main, batch)`` builds the new list; ``label(epoch)`` names its snapshot, rising with the epoch.  A batch that is
    run again after a failure reads the same earlier snapshot and replaces its own.
    """

    def one(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        name = label(epoch)
        every = spark.read.option("basePath", path).parquet(f"{path}/{SNAPSHOT}=*").withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("string"))
        before = every.filter(F.col(SNAPSHOT) < name).agg(F.max(SNAPSHOT)).scalar()
        main = every.filter(F.col(SNAPSHOT) == before).drop(SNAPSHOT)
        # Rows of one batch are read several times by the similarity join.
        merge(main, batch.persist()).write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={name}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_list_stream(
    stream: DataFrame, path: str, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame], label: Callable[[int], str], by: str = "category"
) -> StreamingQuery:
    """Merge each micro-batch into the categories it touches.

    ``merge(list, batch)`` gets the rows of these categories.  ``label(epoch)`` names the version.  A batch that is run again after a failure
    starts from the version before its own.
    """

    def one(batch: DataFrame, epoch: int) -> None:
        spark, version = batch.sparkSession, label(epoch)
        now = manifest_of(spark, path)
        base = now["before"] if now["version"] == version else now["version"]
        # Rows of one batch are read several times by the merge.
        batch = batch.persist()
        touched = [r[0] for r in batch.select(by).distinct().collect()]
        if touched:
            write_list(merge(read_list(spark, path, base, touched), batch), path, version, by, touched, base)
        batch.unpersist()

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
