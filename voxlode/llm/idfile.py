"""Token ids as files: frequency-ranked ids in a byte-aligned variable-length coding with separate control bytes.

A shard holds the ids of consecutive documents.  Its ids are replaced by their rank of frequency within the shard (ties:
smaller id first), so that most take one byte.  Layout, little-endian, one shard after the other:

    magic "RKID", documents u32, ids u64, distinct ids u32, data bytes u64
    distinct ids in rank order, u32 each
    ids per document, u32 each
    control bytes: two bits per id (bytes used, less one), four ids to a byte, lowest bits first
    data bytes: each rank in 1 to 4 bytes

Decoding looks the four lengths of every control byte up in a table of 256 rows and gathers the bytes with numpy.
Shards travel as binary rows of a Parquet table, since only Spark reaches the cluster's store; ``first`` orders them.

Null and empty texts are documents of the end id alone; equal document ids are ordered by a hash of their texts.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import UNSAFE, cut_pieces, expand
from .flat import CACHES, slices

#: Text bytes in a shard: the more, the more pieces are equal.
LOT_BYTES = 8 << 20
#: Pieces that match begin with a space and end with a character that is no white space.
IN_A_ROW = r"^ (?s:.*)[^\s\x0b\x1c-\x1f\x{85}\p{Z}]$"
HEAD = struct.Struct("<4sIQIQ")
MAGIC = b"RKID"
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


def write_shard(ids: np.ndarray, per_doc: np.ndarray) -> bytes:
    count = np.bincount(ids)  # ids are below the size of the vocabulary
    distinct = np.flatnonzero(count)
    order = np.argsort(-count[distinct], kind="stable")
    rank = np.zeros(len(count), np.uint32)
    rank[distinct[order]] = np.arange(len(order), dtype=np.uint32)
    value = rank[ids]
    width = 1 + (value >= 1 << 8) + (value >= 1 << 16) + (value >= 1 << 24)
    at = np.cumsum(width) - width
    data = np.zeros(int(width.sum()), np.uint8)
    for k in range(4):
        has = width > k
        data[at[has] + k] = value[has] >> np.uint32(8 * k) & np.uint32(255)
    padded = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    padded[: len(ids)] = width - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    head = HEAD.pack(MAGIC, len(per_doc), len(ids), len(distinct), len(data))
    return b"".join([head, distinct[order].astype("<u4").tobytes(), per_doc.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def read_shard(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per document) of one shard; raises ValueError on a damaged one."""
    if len(raw) < HEAD.size or raw[:4] != MAGIC:
        raise ValueError("not an id shard")
    _, docs, n, distinct, size = HEAD.unpack_from(raw)
    sizes = np.cumsum([HEAD.size, 4 * distinct, 4 * docs, -(-n // 4), size])
    if sizes[-1] != len(raw):
        raise ValueError("id shard cut short")
    part = [np.frombuffer(raw, np.uint8, b - a, a) for a, b in zip(sizes, sizes[1:])]
    table, per_doc = part[0].view("<u4"), part[1].view("<u4")
    width = LENGTHS[part[2]].ravel()[:n]
    at = np.cumsum(width) - width
    rank = np.zeros(n, np.uint32)
    for k in range(4):
        has = width > k
        rank[has] |= part[3][at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return table[rank], per_doc


class PieceIds:
    """Ids of pieces of texts by the library's tokenizer.

    A space after a character that is no white space is a border of pre-tokens, and pre-tokens are encoded independently of
    each other.  So pieces that begin with such a space and end with such a character go to the library in a row: the lengths
    of the ids in bytes tell where each of them ends.  All other pieces go one by one.

    A worker keeps the ids of the last ``MOST`` pieces of at most ``LENGTH`` bytes.
    """

    ROW, LOT, MOST, LENGTH = 128, 200, 400_000, 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.unsafe = UNSAFE + "".join("|" + _quoted(x) for x in added)
        # Pieces side by side must not make up an added token.
        self.in_a_row = "$^." if any(" " in x for x in added) else IN_A_ROW
        # A byte-level vocabulary has a letter for every byte.
        vocab = self.library.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        self.width[[*vocab.values()]] = [*map(len, vocab)]
        # The pieces of the last lot first, then those of lots before that it had not.
        self.known, self.known_ids, self.known_size = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text)."""
        ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(texts), self.LOT):
            lists = [e.ids for e in self.library.encode_batch_fast(texts[i : i + self.LOT], add_special_tokens=False)]
            size.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            ids.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(size[-1].sum())))
        return np.concatenate(ids), np.concatenate(size)

    def rows(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of pieces that can stand in a row."""
        if not len(pieces):
            return self.encode([])
        border = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        raw = memoryview(pieces.buffers()[2])
        cut = [*border[: -1 : self.ROW].tolist(), int(border[-1])]
        ids, _ = self.encode([str(raw[a:b], "utf-8") for a, b in zip(cut, cut[1:])])
        ends = np.cumsum(self.width[ids])
        last = np.searchsorted(ends, border[1:] - border[0])
        if len(last) and (last[-1] != len(ids) - 1 or (ends[last] != border[1:] - border[0]).any()):
            raise ValueError("an id crosses a border of pre-tokens")
        return ids, np.diff(last, prepend=-1)

    def ids(self, pieces: pa.LargeStringArray, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids per string, which of these strings every piece is); only the last ``whole`` pieces can hold an added token."""
        plain = pieces.slice(0, len(pieces) - whole)
        at = pc.fill_null(pc.index_in(plain, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        asked = plain.take(pa.array(new))
        row = np.array(pc.match_substring_regex(asked, self.in_a_row))
        parts = [self.rows(asked.filter(pa.array(row))), self.encode([*asked.filter(pa.array(~row)).to_pylist(), *pieces.slice(len(plain)).to_pylist()])]
        ids = np.concatenate([self.known_ids, *(p[0] for p in parts)])
        size = np.concatenate([self.known_size, *(p[1] for p in parts)])
        at[new[np.concatenate((np.flatnonzero(row), np.flatnonzero(~row)))]] = len(self.known) + np.arange(len(new))
        which = np.concatenate((at, np.arange(len(size) - whole, len(size))))
        self.remember(plain, at, ids, size)
        return ids, size, which

    def remember(self, pieces: pa.LargeStringArray, at: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        short = np.flatnonzero(np.asarray(pc.binary_length(pieces)) <= self.LENGTH)[: self.MOST]
        unused = np.ones(len(self.known), bool)
        unused[at[at < len(unused)]] = False
        older = np.flatnonzero(unused)[: self.MOST - len(short)]
        which = np.concatenate((at[short], older))
        self.known = pa.concat_arrays([pieces.take(pa.array(short)), self.known.take(pa.array(older))])
        self.known_ids, edge = expand(ids, size, which, np.arange(len(which) + 1))
        self.known_size = np.diff(edge)


@lru_cache(maxsize=2)
def _library(path: str) -> PieceIds:
    return PieceIds(path)


CACHES["ids"] = _library.cache_clear


def _quoted(s: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in s)


def _shards(path: str, end_id: int, kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    library = _library(path)
    part = TaskContext.get().partitionId()
    for seq, rows in enumerate(slices(batches, LOT_BYTES, "ids")):
        pieces, code, offset, whole = cut_pieces(rows.column(1), library.unsafe)
        flat, size, which = library.ids(pieces, whole)
        # Every document gets one more piece: the end.
        flat, size = np.append(flat, np.uint32(end_id)), np.append(size, 1)
        code = np.insert(which[code], offset[1:], len(size) - 1)
        offset = offset + np.arange(len(offset))
        ids, edge = expand(flat, size, code, offset)
        keys = rows.column(0)
        yield pa.RecordBatch.from_arrays(
            [
                keys.slice(0, 1), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
                pa.array([keys.to_pylist()], pa.list_(kind)), pa.array([write_shard(ids, np.diff(edge))], pa.binary()),
            ],
            ["first", "part", "seq", "n_ids", "keys", "shard"],
        )


def write_ids(df: DataFrame, folder: str, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Encode the texts with the library's tokenizer at ``path`` and write id shards in ascending key order."""
    kind = df.schema[key].dataType.simpleString()
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows of one id are ordered, and dealt out, by a hash of their text.
    rows = df.select(df[key].alias("key"), df[text].alias("text"), F.xxhash64(df[text]).alias("mark")).repartitionByRange(width, "key", "mark").sortWithinPartitions("key", "mark")
    arrow = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()
    rows.select("key", "text").mapInArrow(lambda it: _shards(path, end_id, arrow, it), f"first {kind}, part int, seq int, n_ids long, keys array<{kind}>, shard binary").write.option("compression", "none").parquet(folder)


def _documents(key_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for part, seq, keys, raw in zip(*(c.to_pylist() for c in rows.columns)):
            ids, per_doc = read_shard(raw)
            edge = np.concatenate(([0], np.cumsum(per_doc, dtype=np.int64)))
            raw_ids = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw_ids[4 * a : 4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            n = len(keys)
            cols = [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)), pa.array(keys, key_type), pa.array(edge[:-1]), pa.array(np.diff(edge)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["part", "seq", "key", "start", "n_tokens", "ids_crc32"])


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Shards with the number of ids before them: of earlier parts, which are ranges in order, and of earlier shards of the part.

    One task sees one row for each part, not for each shard or document.
    """
    place = spark.read.parquet(folder).select("part", "seq", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = place.groupBy("part").agg(F.sum("n_ids").alias("size")).select("part", F.coalesce(F.sum("size").over(before(Window.orderBy("part"))), F.lit(0)).alias("of_parts"))
    inside = place.select("part", "seq", F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0)).alias("of_shards"))
    return inside.join(parts, "part").select("part", "seq", (F.col("of_parts") + F.col("of_shards")).alias("at"))


def read_index(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the shards."""
    shards = spark.read.parquet(folder)
    kind = shards.schema["first"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()
    rows = shards.select("part", "seq", "keys", "shard").mapInArrow(
        lambda it: _documents(arrow, it), f"part int, seq int, key {kind}, start long, n_tokens long, ids_crc32 long"
    )
    placed = rows.join(shard_starts(spark, folder), ["part", "seq"])
    return placed.select(F.col("key").alias(key), (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, ids array<long>) of every document, the end id included."""
    shards = spark.read.parquet(folder)
    kind = shards.schema["first"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for keys, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                ids, per_doc = read_shard(raw)
                edge = np.concatenate(([0], np.cumsum(per_doc, dtype=np.int64))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys, arrow), pa.ListArray.from_arrays(pa.array(edge), pa.array(ids.astype(np.int64)))], ["key", "ids"])

    return shards.select("keys", "shard").mapInArrow(run, f"key {kind}, ids array<long>").withColumnRenamed("key", key)
