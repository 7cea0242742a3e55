"""Landed JSON containers: one object per (source, category, day) with a payload array under some key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPACE, col

REVIEW = "app_id string, app_name string, author string, rating int, title string, content string, version string, date string, source string, url string"
COMMENT = "id string, author string, content string, created_at string, points int, story_id string, story_title string, story_url string, source_url string, source string"

# Payload keys in order of precedence, and the totals some files declare instead.
PAYLOAD_KEYS = ["reviews", "comments", "complaints", "items", "notes", "data"]
COUNT_KEYS = ["reviews", "comments", "complaints", "total_reviews", "total_comments", "items", "data"]


def read_container(
    spark: SparkSession, path: str | Sequence[str], key: str, item: str, multi_line: bool = True, keep: Sequence[str] = ("category", "crawl_date")
) -> DataFrame:
    """Rows of the payload array ``key``, with the container fields in ``keep`` and ``file_name``.

    The schema is given, so nothing is inferred and unread fields are not parsed.
    """
    head = "".join(f"{k} string, " for k in keep)
    raw = spark.read.schema(f"{head}{key} array<struct<{_ddl(item)}>>").option("multiLine", multi_line).json(path)
    return raw.select(*keep, F.col("_metadata.file_name").alias("file_name"), F.inline(key))


def _ddl(fields: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ", 1) for f in fields.split(",")))


def read_texts(spark: SparkSession, path: str | Sequence[str], whole: bool = True) -> DataFrame:
    """Container texts with their file: (file_name, modified, body); one per file, or one per line."""
    raw = spark.read.text(path, wholetext=whole)
    return raw.select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("body")
    )


def explode_any_key(texts: DataFrame, item: str, keys: Sequence[str] = tuple(PAYLOAD_KEYS)) -> DataFrame:
    """Rows of the first present payload key, or of a bare top-level list."""
    arr = f"array<struct<{_ddl(item)}>>"
    parsed = F.from_json("body", ", ".join(f"`{k}` {arr}" for k in keys))
    bare = F.when(F.ltrim("body").startswith("["), F.from_json("body", arr))
    staged = texts.withColumn("_o", F.when(~F.ltrim("body").startswith("["), parsed)).withColumn("_b", bare)
    payload = F.coalesce("_b", *[F.col(f"_o.{k}") for k in keys])
    return staged.select(*[c for c in texts.columns if c != "body"], F.inline(payload))


def count_payload(texts: DataFrame, keys: Sequence[str] = tuple(COUNT_KEYS)) -> DataFrame:
    """``rows`` per container: size of the first present key, or the declared total; 0 if unreadable."""
    def one(k: str) -> str:
        return f"`{k}` bigint" if k.startswith("total_") else f"`{k}` array<string>"

    staged = texts.withColumn("_o", F.from_json("body", ", ".join(one(k) for k in keys)))
    staged = staged.withColumn("_b", F.when(F.ltrim("body").startswith("["), F.from_json("body", "array<string>")))
    sizes = [F.size("_b")] + [F.col(f"_o.{k}") if k.startswith("total_") else F.size(f"_o.{k}") for k in keys]
    known = [F.when(s >= 0, s) for s in sizes]
    return staged.withColumn("rows", F.coalesce(*known, F.lit(0)).cast("bigint")).drop("_o", "_b", "body")


def first_filled(*candidates: Column | str) -> Column:
    """First candidate that is neither null nor empty; without one the first that isn't null."""
    return F.coalesce(*[F.when(col(c).cast("string") != "", col(c)) for c in candidates], *map(col, candidates))


def unify_source(rows: DataFrame, mapping: Mapping[str, Sequence[str]], constants: Mapping[str, str] | None = None) -> DataFrame:
    """One source in the common shape: each target field is the first filled of its source fields."""
    known = set(rows.columns)
    out = []
    for target, fields in mapping.items():
        have = [f for f in fields if f in known]
        out.append((first_filled(*have) if have else F.lit(None).cast("string")).alias(target))
    return rows.select(*out, *[F.lit(v).alias(k) for k, v in (constants or {}).items()])


def unify_sources(parts: Sequence[DataFrame], text: str = "content", space: str = SPACE) -> DataFrame:
    """Union by name of sources in the common shape; rows whose text is empty or all ``space`` drop."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.filter(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{space}+", "") != "")


def discover_files(spark: SparkSession, folder: str, category: str, suffix: str = ".json") -> DataFrame:
    """Texts of the files whose name starts with the category, with their file name."""
    return read_texts(spark, f"{folder.rstrip('/')}/{category}*{suffix}")


def write_containers(rows: DataFrame, by: Sequence[str], key: str, path: str) -> None:
    """Land rows as container objects, one per line.  ``by`` must bound the rows per container."""
    fields = [c for c in rows.columns if c not in by]
    packed = rows.groupBy(*by).agg(F.collect_list(F.struct(*fields)).alias(key))
    packed.withColumn(f"total_{key}", F.size(key)).write.json(path)


def channel_stats(files: DataFrame, source: str, file: str, modified: str, rows: str, as_of: str, days: int = 365) -> DataFrame:
    """Rows, files and latest file per source, and the grand total (source null).

    ``files`` has one row per file (or per container).  Sources without rows drop.  The reported range ends at ``as_of``.
    """
    agg = files.rollup(source).agg(
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("rows"),
        F.countDistinct(file).alias("files"),
        F.max_by(file, F.struct(modified, file)).alias("latest_file"),
        F.max(modified).alias("latest"),
    )
    end = F.lit(as_of).cast("date")
    return agg.filter("rows > 0").withColumns(
        {"range_start": F.date_sub(end, days).cast("string"), "range_end": end.cast("string")}
    )
