"""Jaccard join of documents on word shingles with token-combination prefixes.

Two different sets with similarity ``percent`` or more share a token among the first ``n - t + 1`` of each in any common order of tokens,
and two tokens among the first ``n - t + 2`` (t: the overlap that they need).  Tokens are ordered by frequency class, rare first, from
a count sketch of all documents with a fixed number of buckets; any order gives the same result, a good one gives few
candidates.

* Equal sets are one node from the start.
* Index.  Rare tokens of the extended prefix are keys by themselves.  Frequent ones (in more than a sixteenth of the documents) are keys
  in pairs only.  Keys of a single node are dropped where the keys meet.
* Links.  A key's nodes are first compared with one pivot of the key, of all pivots the one that shares most keys.  After the linked nodes
  have been joined into components, all pairs of a key that lie in different components, and that sizes and prefix
  places do not rule out, are compared.  Pairs inside a component need no comparison: only components are asked for.
* A candidate pair whose parity signatures differ in more bits than the sets may differ in tokens can't be linked and goes; all others are
  verified on the whole sets (40 bits of each token's hash).  Only sets of such pairs are written and shuffled.

Hot keys: pivots come from partial aggregates, a node is compared with a pivot once, and the second step pairs only the nodes outside a
key's largest component with the others.

A document of fewer words than a shingle is one shingle; without words it has none and is linked to nothing.  Null texts are empty; rows
with equal ids are rows of their own; a null id never becomes a component's id unless it is alone.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import cut, scratch_path, shuffle_width
from .flat import flatten, lower_ascii, mix, range_hashes, slices, text_bytes, window_hashes, words

BUCKET_BITS, SLICE_BITS = 22, 16
FREQUENT_SHARE, FREQUENT_LEAST = 16, 1024
#: Bits of the filter that keeps sets nobody asks for from being written; beyond some ten million documents it lets more through.
FILTER_BITS = 25
NO_ID = -(1 << 63)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Distinct shingles of every text as sorted 64-bit hashes."""
    flat = flatten(texts)
    flat.buf = lower_ascii(flat.buf)
    begin, stop, first = words(flat)
    h = range_hashes(flat.buf, begin, stop)
    wide = window_hashes(h, width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(wide[a : b - width + 1]))
        else:
            out.append(window_hashes(h[a:b], b - a)[:1] if b > a else np.zeros(0, np.uint64))
    return out


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(tokens: np.ndarray) -> bytes:
    """One bit for every token at least: is the number of tokens that fall to it odd?"""
    size = 1 << max(6, (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Two sets with these signatures differ in so many tokens at least."""
    x, y = sorted((np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")), key=len)
    # The halves of a signature make up one of half the size.
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def classes(count: np.ndarray) -> np.ndarray:
    return np.floor(4 * np.log2(1.0 + count)).astype(np.uint8)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


# ---- pass 1: nodes and the sketch ---------------------------------------------------------------------------------


def _nodes(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(1 << BUCKET_BITS, np.uint32)
    names = ["kind", "doc", "mark", "n", "node", "sign", "part", "counts"]
    for rows in slices(batches):
        sets = shingle_sets(text_bytes(rows.column(1)), width)
        if sets:
            count += np.bincount(bucket(np.concatenate(sets)), minlength=len(count)).astype(np.uint32)
        m = len(sets)
        cols = [pa.array(np.zeros(m, np.int32)), rows.column(0), rows.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([signature(s) for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([*cols, pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
    for part, piece in enumerate(count.reshape(-1, 1 << SLICE_BITS)):
        if piece.any():
            row = [pa.array([1], pa.int32()), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.binary()), pa.array([part], pa.int32()), pa.array([zlib.compress(piece.tobytes(), 1)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, names)


def _add_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << SLICE_BITS, np.float64)
    for raw in pdf.counts:
        total += np.frombuffer(zlib.decompress(raw), np.uint32)
    return pd.DataFrame({"part": pdf.part.iloc[:1], "classes": [classes(total).tobytes()]})


# ---- pass 2: the index --------------------------------------------------------------------------------------------

ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("n", "<u4"), ("at", "<u4")])


def index_entries(tokens: np.ndarray, sketch: np.ndarray, frequent: int, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, place of each key's first token, number of single keys) of a set."""
    n = len(tokens)
    level = sketch[bucket(tokens)]
    order = np.lexsort((tokens, level))[: prefix_length(n, percent) + 1]
    token, hot = tokens[order], level[order] >= frequent
    single = int(np.argmax(hot)) if hot.any() else len(order)
    pairs = token[single:]
    i, j = np.triu_indices(len(pairs), 1)
    both = window_hashes(np.column_stack((pairs[i], pairs[j])).ravel(), 2)[::2] if len(i) else np.zeros(0, np.uint64)
    return np.concatenate((token[:single], both)), np.concatenate((np.arange(single), i + single)), single


def _index(width: int, percent: int, sketch: np.ndarray, frequent: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    seen: set[int] = set()
    for turn, rows in enumerate(slices(batches)):
        plain, paired = [], []
        for tokens in shingle_sets(text_bytes(rows.column(1)), width):
            node = set_id(tokens)
            if not len(tokens) or node in seen:
                continue
            if len(seen) < 1_000_000:
                seen.add(node)
            key, at, single = index_entries(tokens, sketch, frequent, percent)
            entry = np.zeros(len(key), ENTRY)
            entry["key"], entry["node"], entry["n"], entry["at"] = key, node, len(tokens), at
            plain.append(entry[:single])
            paired.append(entry[single:])
        out = []
        lot = np.concatenate(plain) if plain else np.zeros(0, ENTRY)
        part = (lot["key"] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(edge)).tolist():
            out.append((p, 0, pack_entries(lot[order[edge[p] : edge[p + 1]]])))
        # Keys of two frequent tokens are not looked for: they stay spread as their documents are.
        lot = np.concatenate(paired) if paired else np.zeros(0, ENTRY)
        for a in range(0, len(lot), 100_000):
            out.append(((task + turn + a // 100_000) % parts, 1, pack_entries(lot[a : a + 100_000])))
        if out:
            p, kind, raw = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(kind, pa.int32()), pa.array(raw, pa.binary())], ["part", "kind", "entries"])


def pack_entries(lot: np.ndarray) -> bytes:
    """Entries as columns: each node once with its size and number of entries, then keys and places."""
    lot = lot[np.argsort(lot["node"], kind="stable")]
    node, first, times = np.unique(lot["node"], return_index=True, return_counts=True)
    head = np.array([len(lot), len(node)], "<u4").tobytes()
    small = zlib.compress(lot["n"][first].tobytes() + times.astype("<u4").tobytes() + lot["at"].tobytes(), 1)
    return head + node.tobytes() + lot["key"].tobytes() + small


def unpack_entries(raw: bytes) -> np.ndarray:
    m, k = np.frombuffer(raw, "<u4", 2).tolist()
    lot = np.zeros(m, ENTRY)
    small = np.frombuffer(zlib.decompress(raw[8 + 8 * (k + m) :]), "<u4")
    times = small[k : 2 * k]
    lot["node"] = np.repeat(np.frombuffer(raw, "<i8", k, 8), times)
    lot["key"] = np.frombuffer(raw, "<u8", m, 8 + 8 * k)
    lot["n"], lot["at"] = np.repeat(small[:k], times), small[2 * k :]
    return lot


def _live(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entries whose key has two nodes at least, and those of frequent pairs as they are."""
    found = [unpack_entries(x) for x in pdf.entries[pdf.kind == 1]]
    lots = [unpack_entries(x) for x in pdf.entries[pdf.kind == 0]]
    if lots:
        lot = np.concatenate(lots)
        lot = lot[np.lexsort((lot["node"], lot["key"]))]
        again = np.zeros(len(lot), bool)
        again[1:] = (lot["key"][1:] == lot["key"][:-1]) & (lot["node"][1:] == lot["node"][:-1])
        lot = lot[~again]
        same = lot["key"][1:] == lot["key"][:-1]
        live = np.zeros(len(lot), bool)
        live[1:] |= same
        live[:-1] |= same
        found.append(lot[live])
    lot = np.concatenate(found)
    return pd.DataFrame({"key": lot["key"].view("<i8"), "node": lot["node"], "n": lot["n"].astype(np.int64), "at": lot["at"].astype(np.int64)})


def doc_bits(docs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two places of every id in the filter of chosen documents."""
    h = mix(np.array([NO_ID if d is None else d for d in docs.to_pylist()], np.int64).view(np.uint64))
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for rows in batches:
        for at in doc_bits(rows.column(0)):
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    for part, piece in enumerate(bits.reshape(-1, 1 << SLICE_BITS)):
        if piece.any():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(piece.tobytes(), 1)], pa.binary())], ["part", "bits"])


def _unite_marks(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << SLICE_BITS, np.uint8)
    for raw in pdf.bits:
        total |= np.frombuffer(zlib.decompress(raw), np.uint8)
    return pd.DataFrame({"part": pdf.part.iloc[:1], "bits": [total.tobytes()]})


def _sets(width: int, bits: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets of the documents that the filter lets through.  Some may come that weren't chosen, or twice: they change
    nothing, since pairs name the nodes that are compared."""
    for rows in slices(batches):
        first, second = doc_bits(rows.column(0))
        inside = (bits[first >> 3] >> (first & 7) & bits[second >> 3] >> (second & 7) & 1).astype(bool)
        texts = rows.column(1).filter(pa.array(inside))
        sets = shingle_sets(text_bytes(texts), width) if len(texts) else []
        yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), pa.array([packed_set(s) for s in sets], pa.binary())], ["node", "tokens"])


# ---- candidates and verification ----------------------------------------------------------------------------------


def may_link(na: str, nb: str, ia: str, ib: str, percent: int) -> Column:
    """Sizes, and places of the shared prefix token, allow the similarity."""
    t = f"ceil({percent} * ({na} + {nb}) / {100 + percent}.0D)"
    return F.expr(f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb}) AND {ia} <= {na} - {t} AND {ib} <= {nb} - {t}")


def packed_set(tokens: np.ndarray) -> bytes:
    """40 bits of every token."""
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, 3:]).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, 3:] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _verify(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        keep = []
        for x, y in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist()):
            a, b = unpacked(x), unpacked(y)
            both = np.sort(np.concatenate((a, b)))
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        yield pa.RecordBatch.from_arrays([rows.column(0).filter(pa.array(keep, pa.bool_())), rows.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])


def _possible(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        keep = []
        for na, nb, x, y in zip(*(rows.column(i).to_pylist() for i in (2, 3, 4, 5))):
            # Sets that share s tokens differ in na + nb - 2 * s.
            most = na + nb - 2 * -(-percent * (na + nb) // (100 + percent))
            keep.append(least_difference(x, y) <= most)
        yield pa.RecordBatch.from_arrays([rows.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])


def possible(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the signatures (node, n, sign) don't rule out."""
    of = lambda x: signs.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sign").alias(f"sign_{x}"))
    both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    return both.select("a", "b", "na", "nb", "sign_a", "sign_b").mapInArrow(lambda it: _possible(percent, it), "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough."""
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    with_both = with_b.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    return with_both.select("a", "b", "tokens_a", "tokens_b").mapInArrow(lambda it: _verify(percent, it), "a long, b long")


def labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with the component of their node."""
    parts = connected_components(edges, "a", "b").withColumnRenamed("component", "joined")
    return rows.join(parts, "node", "left").withColumn("component", F.coalesce("joined", "node")).drop("joined")


def linked(df: DataFrame, percent: int, width: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((doc, mark, n, node) of every row, (node, component, least) of every set with shingles); mark is the hash of the text."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("doc"), F.col(text).alias("text"), mark_of(text).alias("mark"))
    parts = max(shuffle_width(spark), 16)
    folder = scratch_path(spark, "ngram-nodes")
    docs.mapInArrow(lambda it: _nodes(width, it), "kind int, doc long, mark long, n long, node long, sign binary, part int, counts binary").write.partitionBy("kind").parquet(folder)
    stored = spark.read.schema("doc long, mark long, n long, node long, sign binary, part int, counts binary, kind int").parquet(folder)
    nodes = stored.filter("kind = 0").select("doc", "mark", "n", "node")
    # One class byte for each of 2 ** BUCKET_BITS buckets, whatever the size of the corpus.
    sketch = np.zeros(1 << BUCKET_BITS, np.uint8)
    for r in stored.filter("kind = 1").groupBy("part").applyInPandas(_add_counts, "part int, classes binary").collect():
        sketch[r.part << SLICE_BITS : (r.part + 1) << SLICE_BITS] = np.frombuffer(r.classes, np.uint8)
    frequent = int(classes(np.array([max(FREQUENT_LEAST, nodes.count() // FREQUENT_SHARE)]))[0])
    shared = spark.sparkContext.broadcast(sketch)
    index = docs.mapInArrow(lambda it: _index(width, percent, shared.value, frequent, parts, it), "part int, kind int, entries binary")
    folder = scratch_path(spark, "ngram-live")
    index.groupBy("part").applyInPandas(_live, "key long, node long, n long, at long").write.parquet(folder)
    live = spark.read.schema("key long, node long, n long, at long").parquet(folder)

    signs = stored.filter("kind = 0 AND n > 0").select("node", "n", "sign").dropDuplicates(["node"])

    def linking(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough."""
        likely = cut(possible(pairs, signs, percent))
        # Whole sets of their nodes, one document for each.
        asked = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        chosen = nodes.join(asked, "node", "left_semi").groupBy("node").agg(F.min("doc").alias("doc"))
        bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
        for r in chosen.select("doc").mapInArrow(_mark, "part int, bits binary").groupBy("part").applyInPandas(_unite_marks, "part int, bits binary").collect():
            bits[r.part << SLICE_BITS : (r.part + 1) << SLICE_BITS] = np.frombuffer(r.bits, np.uint8)
        marks = spark.sparkContext.broadcast(bits)
        folder = scratch_path(spark, "ngram-sets")
        docs.mapInArrow(lambda it: _sets(width, marks.value, it), "node long, tokens binary").write.parquet(folder)
        sets = spark.read.schema("node long, tokens binary").parquet(folder)
        return verified(likely, sets, percent)

    # The node in which a key comes first has the fewest tokens of its own before it: the likeliest original.
    member = F.struct("at", "node", "n")
    pivots = live.groupBy("key").agg(F.min(member).alias("pivot"))
    near = (
        live.join(pivots, "key").select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("pivot.node").alias("b"), F.col("pivot.n").alias("nb"), F.col("pivot.at").alias("ib"))
        .filter("a <> b").filter(may_link("na", "nb", "ia", "ib", percent))
        .groupBy("a", "b").count()
        .groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b"))
    )
    near = cut(near)
    edges = cut(linking(near))
    rows = cut(labelled(live, edges))

    sizes = rows.groupBy("key", "component").count()
    mixed = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("components"), F.max_by("component", F.struct("count", "component")).alias("largest")).filter("components > 1")
    inside = rows.join(mixed.select("key", "largest"), "key")
    few = inside.filter("component <> largest").select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("component").alias("ca"))
    others = inside.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("at").alias("ib"), F.col("component").alias("cb"), "largest")
    rest = (
        few.join(others, "key").filter("ca <> cb AND (cb = largest OR a < b)").filter(may_link("na", "nb", "ia", "ib", percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    known = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = cut(rest.join(known, ["a", "b"], "left_anti"))
    edges = edges.unionByName(linking(rest))

    of_node = nodes.filter("n > 0").groupBy("node").agg(F.min("doc").alias("least"))
    return nodes, labelled(of_node, edges)


def components(df: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every document; component_id is the smallest key that links reach."""
    nodes, named = linked(df, percent, width, key, text)
    low = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(low, "component").select("node", "component_id")
    out = nodes.join(found.withColumn("some", F.lit(True)), (nodes["node"] == found["node"]) & (nodes["n"] > 0), "left")
    return out.select(nodes["doc"].alias(key), nodes["n"].alias("n_shingles"), F.when(F.col("some"), F.col("component_id")).otherwise(nodes["doc"]).alias("component_id"))


def mark_of(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def keep_one(df: DataFrame, percent: int = 80, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays, with all its columns: that with the smallest id (null ids last), then the smallest hash of its text.

    Rows are judged by id and text together, so a row isn't dropped because another text has its id, and repeated rows leave one.  Rows without words
    stay as they are.
    """
    nodes, named = linked(df, percent, width, key, text)
    kinds = nodes.filter("n > 0").groupBy("doc", "mark", "node").agg(F.count(F.lit(1)).alias("times")).join(named.select("node", "component"), "node")
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark")
    first = kinds.groupBy("component").agg(F.min(place).alias("first"))
    told = cut(kinds.join(first, "component").select("doc", "mark", (F.col("first") == place).alias("stays"), (F.col("times") > 1).alias("again")))
    names = df.columns
    rows = df.toDF(*(f"x{i}" for i in range(len(names))))
    own, body = f"x{names.index(key)}", f"x{names.index(text)}"
    rows = rows.withColumn("own_mark", mark_of(body))
    same = lambda t: rows[own].eqNullSafe(t["doc"]) & (rows["own_mark"] == t["mark"])
    moved, again = told.filter("NOT stays OR again"), told.filter("stays AND again")
    out = rows.join(moved, same(moved), "left_anti").unionByName(rows.join(again, same(again), "left_semi").dropDuplicates([own, "own_mark"]))
    return out.select(*(F.col(f"x{i}").alias(n) for i, n in enumerate(names)))
