"""Benchmark leaks found with suffix arrays of the training text.

A slice of documents is a shard: its words are numbered by the benchmark's vocabulary, and its suffix array holds the
suffixes that start with enough benchmark words in a row to hold a window at all (no other can match), ordered by their
first ``depth`` words.  Every test suffix is looked up by binary search; the hits of an item on a diagonal are joined into the longest
verbatim matches with their places.  A document is affected if any window of an item occurs in it.

The benchmark is taken in blocks of about ``BLOCK`` bytes; a block's items are sent to all tasks, and each block looks at all documents.

Null and empty texts have no words.  An item of fewer than ``depth`` words is one window, an item without words matches nothing.  Rows
stay rows: repeated and null ids are judged one by one.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import byte_table, flatten, lower_ascii, range_hashes, slices, text_bytes, words

BLOCK = 4 << 20
#: Bytes that are not part of a word: all ASCII but digits and letters.
SEPARATOR = byte_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
MATCH = "array<struct<item_id:{kind},item_start:int,doc_start:int,n_words:int>>"


def text_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the end)."""
    flat = flatten(texts)
    flat.buf = lower_ascii(flat.buf)
    begin, stop, first = words(flat, SEPARATOR)
    return range_hashes(flat.buf, begin, stop), first


class TestSuffixes:
    """Distinct windows of a block of items as sorted search keys, and which items have them where."""

    def __init__(self, items: list[tuple], depth: int):
        hashes, first = text_words([(t or "").encode() for _, t in items])
        self.ids = [i for i, _ in items]
        self.depth = depth
        self.vocabulary = np.unique(hashes)
        number = np.searchsorted(self.vocabulary, hashes).astype(np.uint32) + 1
        length = np.diff(first)
        rows, item, at = [], [], []
        for i, (a, n) in enumerate(zip(first[:-1].tolist(), length.tolist())):
            for j in range(max(n - depth, 0) + 1 if n else 0):
                rows.append(np.pad(number[a + j : a + min(j + depth, n)], (0, depth - min(depth, n))))
                item.append(i)
                at.append(j)
        table = np.array(rows, np.uint32).reshape(-1, depth)
        self.windows, of = np.unique(table, axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        self.item, self.at = np.array(item, np.int64)[order], np.array(at, np.int64)[order]
        self.first = np.searchsorted(of.ravel()[order], np.arange(len(self.windows) + 1))
        self.width = (self.windows > 0).sum(1)
        self.least = int(self.width.min(initial=depth))
        self.low = as_keys(self.windows)
        self.high = as_keys(np.where(self.windows > 0, self.windows, np.uint32(0xFFFFFFFF)))


def as_keys(table: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings that sort alike."""
    return np.ascontiguousarray(table.astype(">u4")).view(f"S{4 * table.shape[1]}").ravel()


def suffix_array(number: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) in suffix order, for the places that are followed by ``least`` known words (number > 0) at least."""
    known = number > 0
    ends = np.flatnonzero(~known)
    after = np.concatenate((ends, [len(number)]))
    place = np.flatnonzero(known)
    room = after[np.searchsorted(ends, place)] - place
    keep = room >= least
    place, room = place[keep], room[keep]
    padded = np.concatenate((number, np.zeros(depth, np.uint32)))
    table = padded[place[:, None] + np.arange(depth)]
    table[np.arange(depth) >= room[:, None]] = 0
    keys = as_keys(table)
    order = np.argsort(keys, kind="stable")
    return keys[order], place[order]


def _repeat_ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, member) for all members of the ranges lo:hi."""
    n = hi - lo
    ends = np.cumsum(n)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n - lo, n)


def shard_matches(texts: list[bytes], tests: TestSuffixes) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words per text, [text, item, place in the item, place in the text, words] of the longest matches)."""
    hashes, first = text_words(texts)
    n_words = np.diff(first)
    none = [np.zeros(0, np.int64)] * 5
    if not len(tests.windows) or not len(hashes):
        return n_words, none
    number = np.searchsorted(tests.vocabulary, hashes)
    number[number == len(tests.vocabulary)] = 0
    number = np.where(tests.vocabulary[number] == hashes, number + 1, 0).astype(np.uint32)
    # A gap after every text keeps suffixes inside it.
    text_of = np.repeat(np.arange(len(texts)), n_words)
    spaced = np.zeros(len(number) + len(texts), np.uint32)
    spaced[np.arange(len(number)) + text_of] = number
    keys, place = suffix_array(spaced, tests.depth, tests.least)
    window, entry = _repeat_ranges(np.searchsorted(keys, tests.low), np.searchsorted(keys, tests.high, side="right"))
    if not len(window):
        return n_words, none
    which, member = _repeat_ranges(tests.first[window], tests.first[window + 1])
    at, item, item_at, width = place[entry][which], tests.item[member], tests.at[member], tests.width[window][which]
    start = first[:-1] + np.arange(len(texts))
    text = np.searchsorted(start, at, side="right") - 1
    at = at - start[text]
    order = np.lexsort((at, at - item_at, item, text))
    text, item, item_at, at, width = (x[order] for x in (text, item, item_at, at, width))
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(at) != 1) | (np.diff(at - item_at) != 0)
    head = np.flatnonzero(new)
    run = np.diff(np.concatenate((head, [len(at)])))
    return n_words, [text[head], item[head], item_at[head], at[head], run - 1 + width[head]]


def _scan(tests: TestSuffixes, kind: pa.DataType, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([("item_id", kind), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())])
    for rows in slices(batches):
        n_words, (text, item, item_at, at, size) = shard_matches(text_bytes(rows.column(1)), tests)
        values = pa.StructArray.from_arrays(
            [pa.array([tests.ids[i] for i in item.tolist()], kind), *(pa.array(x, pa.int32()) for x in (item_at, at, size))], fields=list(struct)
        )
        edge = pa.array(np.searchsorted(text, np.arange(rows.num_rows + 1)), pa.int32())
        found = pa.ListArray.from_arrays(edge, values)
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(n_words), found], names)


def find_leaks(
    docs: DataFrame, bench: DataFrame, depth: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """(key, [carry], n_words, matches) of every document; a match has item_id, item_start, doc_start and n_words.

    ``carry`` names further columns of ``docs`` to pass on (the text may be one of them).
    """
    size = bench.agg(F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK))
    kind = bench.schema[item].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    inner = ["key", "text", *(f"c{i}" for i in range(len(carry))), "n_words", "matches"]
    passed = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(inner, [key, text, *carry]))
    schema = f"{passed}, n_words long, found {MATCH.format(kind=kind)}"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    for b in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64(item, item_text), F.lit(blocks)) == b) if blocks > 1 else bench
        tests = TestSuffixes([tuple(r) for r in part.select(item, item_text).collect()], depth)
        if b:  # the matches so far go along with their row
            step = schema.replace("n_words long", f"matches {MATCH.format(kind=kind)}, n_words long")
            names = [*inner[:-2], "matches", "n_words", "found"]
            out = rows.select(*inner[:-2], "matches").mapInArrow(lambda it, tests=tests, names=names: _scan(tests, arrow, names, it), step)
            rows = out.select(*inner[:-2], "n_words", F.concat("matches", "found").alias("matches"))
        else:
            names = [*inner[:-1], "found"]
            rows = rows.select(*inner[:-2]).mapInArrow(lambda it, tests=tests, names=names: _scan(tests, arrow, names, it), schema).withColumnRenamed("found", "matches")
    return rows.select(F.col("key").alias(key), *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "n_words", "matches")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated)."""
    hit = F.array_distinct(F.flatten(F.transform("matches", lambda m: F.sequence(m["doc_start"], m["doc_start"] + m["n_words"] - 1))))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: F.coalesce(m["item_id"].cast("string"), F.lit("")))))
    out = found.select(key, "n_words", F.size(hit).cast("long").alias("n_hit"), items.alias("items"))
    return out.select(key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, bench: DataFrame, depth: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a match, with all their columns."""
    names = docs.columns
    plain = docs.toDF(*(f"x{i}" for i in range(len(names))))
    found = find_leaks(plain, bench, depth, f"x{names.index(key)}", f"x{names.index(text)}", carry=[f"x{i}" for i in range(len(names)) if names[i] != key])
    return found.filter(F.size("matches") == 0).select(*(F.col(f"x{i}").alias(n) for i, n in enumerate(names)))


#: The same with every window of every text spelled out.
ORACLE = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), t AS MATERIALIZED (
  SELECT DISTINCT item, n, array_to_string(w[i + 1:i + n], ' ') AS said
  FROM (SELECT item, w, n, unnest(range(len(w) - n + 1)) AS i FROM (SELECT item, w, least(len(w), {depth}) AS n FROM b WHERE len(w) > 0))
), h AS MATERIALIZED (
  SELECT p.r, p.i, p.n, t.item FROM (
    SELECT r, n, i, array_to_string(w[i + 1:i + n], ' ') AS said FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM t))
  ) p JOIN t ON t.n = p.n AND t.said = p.said
), k AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM h) GROUP BY r),
m AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (r) LEFT JOIN m USING (r)
"""
