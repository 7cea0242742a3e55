"""Sharding by extendible hashing, with DataFrame functions alone.

A row's hash is 48 bits long.  A directory entry is a prefix of these bits; an entry whose rows take more than ``limit`` bytes is
split on the next bit, all others stay whole.  One aggregate per ``STEP`` bits gives the sizes of all prefixes of that length; only
prefixes that are still too large go on to the next bits.

The first 32 bits come from the key, the others from the payload, so that rows of one key are parted by their content.  What is
equal in all 48 bits and still too large stays one shard, marked ``oversize``.  A null key is hashed as the empty string, a null or
empty payload has no bytes.  An empty table has no shards.  Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

BITS, STEP = 48, 12


def hash_bits(key: str, payload: str) -> Column:
    """48 bits as a long."""
    head = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 8)
    tail = F.substring(F.md5(F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")), 1, 4)
    return F.conv(F.concat(head, tail), 16, 10).cast("long")


def _level(rows: DataFrame, open_: DataFrame | None, low: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Splits by the bits from ``low`` on: (entries, still open).

    entries: fine (the first low + STEP bits), depth, prefix, shard_bytes, shard_rows, oversize of its leaf, for all fine
    prefixes below a leaf; still open: the fine prefixes that are too large as they are.
    """
    high = low + STEP
    if open_ is not None:
        rows = rows.join(open_, F.shiftrightunsigned(rows["h"], BITS - low) == open_["top"], "left_semi")
    fine = cut(
        rows.groupBy(F.shiftrightunsigned("h", BITS - high).alias("fine")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    )
    paths = fine.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("prefix", F.expr(f"shiftrightunsigned(fine, {high} - depth)"))
    totals = paths.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    last = F.lit(high == BITS)
    leaf = (F.col("shard_bytes") <= limit) | (last & (F.col("depth") == high))
    # The shallowest prefix that fits is the leaf: all above it were split.
    entries = (
        paths.select("fine", "depth", "prefix").join(totals.filter(leaf), ["depth", "prefix"])
        .groupBy("fine").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("leaf")).select("fine", "leaf.*")
        .withColumn("oversize", F.col("shard_bytes") > limit)
    )
    return cut(entries), fine.filter(F.col("bytes") > limit).select(F.col("fine").alias("top"))


def assign(df: DataFrame, limit: int, key: str = "doc_id", payload: str = "text") -> DataFrame:
    """(key, n_bytes, depth, prefix, shard_bytes, shard_rows, oversize) of every row.

    A row finds its directory entry by an equi-join on a bit prefix, level by level; the entries of a level are at
    most ``2 ** STEP`` per split prefix above.
    """
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    rows = df.select(F.col(key).alias("key"), hash_bits(key, payload).alias("h"), F.coalesce(F.octet_length(F.col(payload).cast("string")), F.lit(0)).cast("long").alias("size"))
    found, open_ = rows, None
    fields = ["depth", "prefix", "shard_bytes", "shard_rows", "oversize"]
    for low in range(0, BITS, STEP):
        entries, open_ = _level(rows, open_, low, limit)
        entries = entries.select(F.col("fine"), F.struct(*fields).alias(f"leaf{low}"))
        found = found.join(entries, F.shiftrightunsigned(F.col("h"), BITS - low - STEP) == entries["fine"], "left").drop("fine")
        if open_.isEmpty():
            break
    leaf = F.coalesce(*[c for c in found.columns if c.startswith("leaf")])
    return found.select(F.col("key").alias(key), F.col("size").alias("n_bytes"), leaf.alias("leaf")).select(key, "n_bytes", "leaf.*")


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard."""
    return assigned.select("depth", "prefix", "shard_bytes", "shard_rows", "oversize").distinct()


ORACLE = """
WITH r AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) || substr(md5(coalesce(text, '')), 1, 4) AS BIGINT) AS h
  FROM documents
), e AS (
  SELECT doc_id, size, d, h >> CAST(48 - d AS INTEGER) AS prefix,
         sum(size) OVER (PARTITION BY d, h >> CAST(48 - d AS INTEGER)) AS total,
         count(*) OVER (PARTITION BY d, h >> CAST(48 - d AS INTEGER)) AS n
  FROM r, range(0, 49) AS s(d)
)
SELECT doc_id, CAST(size AS BIGINT) AS n_bytes, CAST(d AS INTEGER) AS depth, CAST(prefix AS BIGINT) AS prefix,
       CAST(total AS BIGINT) AS shard_bytes, n AS shard_rows, total > {limit} AS oversize
FROM e WHERE total <= {limit} OR d = 48
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1
"""
