"""Vector codes by product quantisation in exact integers, with LAESA pivots.

A vector's components become integers and it is cut into equal parts.  Each part position has a codebook; rounds assign every
part to the nearest entry (squared Euclidean distance, ties to the lower index) and move each entry to the floor of its parts'
mean.  Pivots are fixed points of each part position (the first entries of the starting codebook).  The distance of every part to every
pivot is computed once and kept beside the part; in a round only the few distances between pivots and entries are new.  The triangle
inequality turns both into a lower bound for each part and entry: entries are tried in the order of their bounds, and a part is
finished when the next bound exceeds its best exact distance.  Bounds only save work, the distances that decide are exact.

The driver holds codebooks and one sum per part, entry and component, whatever the number of vectors.  Sums of a task meet in an aggregate.

Vectors that are null or hold a null, NaN or infinite component are dropped.  Fewer vectors than entries make shorter codebooks; an empty
table gives no rows.  Repeated rows stay rows; equal ids among the starting entries go by their components, null ids come last.
Vectors of different lengths, of a length that the parts don't divide, or with components beyond 2^26 after scaling raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

PIVOTS = 4
#: Rows that numpy takes at a time, and the largest component (sums of their products stay below 2^63).
LOT, LARGEST = 8192, 1 << 26


@dataclass
class Codebooks:
    """entries[part, entry, component] and the pivots, both integers."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to those of ``b``."""
    d = a - b
    return (d * d).sum(-1)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """[row, part, pivot] of ``x`` [row, part, component]."""
    return np.sqrt(squared(x[:, :, None, :], pivots[None]).astype(np.float64)).astype(np.float32)


def nearest(x: np.ndarray, near: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance) of every part [row, part], and how many distances were evaluated."""
    n, parts = x.shape[:2]
    code, best, tried = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64), 0
    for p in range(parts):
        entries = books.entries[p]
        apart = np.sqrt(squared(entries[:, None], books.pivots[p][None]).astype(np.float64))
        bound = np.zeros((n, len(entries)))
        for v in range(books.pivots.shape[1]):
            own = near[:, p, v, None].astype(np.float64)
            # Less what float rounding can add: a bound must never exceed the distance.
            np.maximum(bound, np.abs(own - apart[None, :, v]) - 1e-6 * (own + apart[None, :, v] + 1), out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        least, chosen = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        open_ = np.arange(n)
        for r in range(len(entries)):
            e = order[open_, r]
            if r:
                b = bound[open_, e]
                go = b * b <= least[open_]
                open_, e = open_[go], e[go]
                if not len(open_):
                    break
            d = squared(x[open_, p], entries[e])
            tried += len(d)
            better = (d < least[open_]) | (d == least[open_]) & (e < chosen[open_])
            least[open_[better]], chosen[open_[better]] = d[better], e[better]
        code[:, p], best[:, p] = chosen, least
    return code, best, tried


def whole(vector: Column) -> Column:
    """The vector and all its components are there and finite."""
    return vector.isNotNull() & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))


def scaled(lists: pa.Array, scale: int, length: int) -> np.ndarray:
    """[row, component] as integers."""
    if any(n != length for n in lists.value_lengths().to_pylist()):
        raise ValueError(f"vectors must all have {length} components")
    v = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if v.size and np.abs(v).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST / scale}")
    return v.astype(np.int64).reshape(len(lists), length)


def _pack(scale: int, length: int, parts: int, pivots: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, LOT):
            rows = batch.slice(a, LOT)
            x = scaled(rows.column(2), scale, length)
            near = pivot_distances(x.reshape(len(x), parts, -1), pivots)
            fields = [pa.array([r.tobytes() for r in y], pa.binary()) for y in (x.astype("<i4"), near.astype("<f4"))]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *fields], ["key", "label", "ints", "near"])


def _unpack(rows: pa.RecordBatch, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    parts, pivots = books.pivots.shape[:2]
    n = rows.num_rows
    ints, near = (b"".join(rows.column(i).to_pylist()) for i in (2, 3))
    return np.frombuffer(ints, "<i4").astype(np.int64).reshape(n, parts, -1), np.frombuffer(near, "<f4").reshape(n, parts, pivots)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, LOT):
            yield batch.slice(a, LOT)


def _sums(books: Codebooks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, entry, component, total, n) of a task's parts."""
    total = np.zeros(books.entries.shape, np.int64)
    count = np.zeros(books.entries.shape[:2], np.int64)
    for rows in _lots(batches):
        x, near = _unpack(rows, books)
        code, _, _ = nearest(x, near, books)
        for p in range(x.shape[1]):
            count[p] += np.bincount(code[:, p], minlength=count.shape[1])
            # Products of whole numbers below 2^53 are exact in floats.
            total[p] += ((code[:, p] == np.arange(count.shape[1])[:, None]).astype(np.float64) @ x[:, p].astype(np.float64)).astype(np.int64)
    used = count > 0
    part, entry = (i.repeat(total.shape[2]) for i in np.nonzero(used))
    at = np.tile(np.arange(total.shape[2]), int(used.sum()))
    yield pa.RecordBatch.from_pandas(
        pd.DataFrame({"part": part.astype(np.int32), "entry": entry.astype(np.int32), "at": at.astype(np.int32), "total": total[part, entry, at], "n": count[part, entry]}), preserve_index=False
    )


def _codes(books: Codebooks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _lots(batches):
        code, best, _ = nearest(*_unpack(rows, books), books)
        names = pa.array([c.tobytes().hex() for c in code.astype(np.uint8)], pa.string())
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), names, pa.array(best.sum(1))], ["key", "label", "code", "error"])


def packed(df: DataFrame, key: str, label: str, vector: str, parts: int, entries: int, scale: int) -> tuple[DataFrame, Codebooks] | None:
    """Integers and pivot distances of every kept vector, written once, and the starting codebooks; None without vectors."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index takes one byte")
    kept = df.select(df[key].alias("key"), df[label].alias("label"), df[vector].alias("vector")).filter(whole(F.col("vector")))
    head = kept.orderBy(F.asc_nulls_last("key"), "vector").limit(entries).collect()
    if not head:
        return None
    length = len(head[0].vector)
    if length % parts:
        raise ValueError(f"{length} components don't make {parts} equal parts")
    start = scaled(pa.array([list(r.vector) for r in head], pa.list_(pa.float64())), scale, length).reshape(len(head), parts, -1).transpose(1, 0, 2).copy()
    books = Codebooks(start, start[:, :PIVOTS].copy())
    kinds = {f: df.schema[c].dataType.simpleString() for f, c in (("key", key), ("label", label))}
    folder = scratch_path(df.sparkSession, "vector-parts")
    kept.mapInArrow(lambda it, pivots=books.pivots: _pack(scale, length, parts, pivots, it), f"key {kinds['key']}, label {kinds['label']}, ints binary, near binary").write.parquet(folder)
    return df.sparkSession.read.parquet(folder), books


def learn(rows: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """The codebooks after ``rounds`` rounds over all packed rows; unused entries stay."""
    for _ in range(rounds):
        sums = rows.mapInArrow(lambda it, books=books: _sums(books, it), "part int, entry int, at int, total long, n long")
        found = sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        entries = books.entries.copy()
        for r in found:
            entries[r.part, r.entry, r.at] = r.total // r.n
        books = Codebooks(entries, books.pivots)
    return books


def compress(df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(key, label, code, error, codebooks_sha256) of every kept vector; a code has two hex digits for each part."""
    spark = df.sparkSession
    made = packed(df, key, label, vector, parts, entries, scale)
    kinds = f"key {df.schema[key].dataType.simpleString()}, label {df.schema[label].dataType.simpleString()}"
    if made is None:
        out, books = spark.createDataFrame([], f"{kinds}, code string, error long"), None
    else:
        rows, books = made
        books = learn(rows, books, rounds)
        folder = scratch_path(spark, "vector-codes")
        rows.mapInArrow(lambda it: _codes(books, it), f"{kinds}, code string, error long").write.parquet(folder)
        out = spark.read.parquet(folder)
    name = books.digest() if books else hashlib.sha256(b"").hexdigest()
    return out.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", F.lit(name).alias("codebooks_sha256"))


def with_label_error(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` with the errors of equal labels added up in ``label_error``; null is a label of its own."""
    totals = codes.groupBy(F.col(label).alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, codes[label].eqNullSafe(totals["of"])).drop("of")


def oracle(parts: int, entries: int, rounds: int, scale: int) -> str:
    """The same in SQL, all distances evaluated, one step after the other."""
    steps = [f"""
v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding AS e, len(embedding) // {parts} AS d
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT r, p, [CAST(floor({scale} * CAST(e[p * d + i] AS DOUBLE)) AS BIGINT) FOR i IN range(1, d + 1)] AS c FROM v, range({parts}) AS t(p)
), b0 AS MATERIALIZED (SELECT p, r AS j, c FROM x WHERE r < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT r, p, min(CAST(q AS HUGEINT) * 256 + j) AS least FROM (
    SELECT x.r, x.p, b.j, list_sum([(x.c[i] - b.c[i]) * (x.c[i] - b.c[i]) FOR i IN range(1, len(x.c) + 1)]) AS q FROM x JOIN b{k} b ON x.p = b.p
  ) GROUP BY r, p
)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
  SELECT p, j, list(m ORDER BY i) AS c FROM (
    SELECT x.p, CAST(a.least % 256 AS BIGINT) AS j, u.i, CAST((sum(x.c[u.i]) - ((sum(x.c[u.i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM x JOIN a{k} a ON x.r = a.r AND x.p = a.p, LATERAL (SELECT unnest(range(1, len(x.c) + 1)) AS i) u GROUP BY 1, 2, 3
  ) GROUP BY p, j
), b{k + 1} AS MATERIALIZED (SELECT b.p, b.j, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.j = m.j)""")
    steps.append(f"""o AS (
  SELECT v.vec_id, v.label, string_agg(printf('%02x', CAST(a.least % 256 AS BIGINT)), '' ORDER BY a.p) AS code, CAST(sum(a.least // 256) AS BIGINT) AS error
  FROM v JOIN a{rounds} a ON v.r = a.r GROUP BY v.r, v.vec_id, v.label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) FROM b{rounds}) AS codebooks_sha256
FROM o""")
    return "WITH " + ", ".join(steps)


ORACLE = oracle(8, 16, 6, 4096)
