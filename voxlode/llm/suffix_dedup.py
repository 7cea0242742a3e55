"""Repeated byte strings across documents, by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of ``width`` bytes around it also starts earlier (smaller id, or same document and smaller start).

* Sampled suffixes.  In every window of ``width`` bytes the ``SEED``-byte string with the smallest hash (the leftmost of equals) is its
  anchor.  Equal windows have the same anchor at the same place, so nothing is lost by sorting one suffix per anchor: the
  bytes from the anchor to the end of the last window that it serves, then those from the first such window up to the anchor.
  That is about one suffix for 33 bytes.
* Runs.  A task sorts the suffixes of its texts, keeps the earliest of equal ones (the others are repeats), and
  front-codes the rest: length of the prefix shared with the suffix before, then the other bytes.
* Exchange by range.  Splitters are quantiles of a bounded sample of suffixes (``SAMPLE`` documents); they only balance the work.
* Merge.  A loser tree over the runs of a range keeps for every loser the prefix it shares with the last winner.  The longer
  shared prefix wins without looking at bytes; equal ones are compared from there on.
* Windows.  Suffixes that share the anchor's string are neighbours now.  Equal suffixes make all windows but the
  earliest's repeats.  Where suffixes of an anchor differ, the windows in reach of the common prefixes are compared one by one.  An
  anchor whose suffixes lie on both sides of a splitter sends its windows through a second exchange and merge.

A hot string costs a run one suffix, however often it occurs; a hot anchor with many different suffixes is cut by the
splitters.  No task holds more than a run or a range.

Null and empty texts have no windows; a null id counts as the smallest.  Rows that share an id are one document: its texts in
order of their bytes, with borders that no window crosses.  Other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_width
from .flat import PRIME, give_back, mix

SEED = 24
PIECE = 1 << 20
RUN = 125_000
RANGE_BYTES = 4 << 20
SAMPLE = 2_000
NO_ID = -(1 << 63)
KEY_BITS = np.uint64((1 << 21) - 1)
HEAD = struct.Struct("<Iqqq")


# ---- suffixes of a text -------------------------------------------------------------------------------------------


def seed_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the ``SEED`` bytes at every place (by doubling: 8 and 16 bytes give 24)."""
    h, size = mix(buf.astype(np.uint64) + np.uint64(1)), 1
    parts = {}
    while size < SEED:
        parts[size] = h
        h = h[:-size] * np.uint64(pow(PRIME, size, 1 << 64)) + h[size:]
        size *= 2
    a, b = parts[16], parts[8]
    n = len(buf) - SEED + 1
    return mix(a[:n] * np.uint64(pow(PRIME, 8, 1 << 64)) + b[16 : 16 + n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchored(buf: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of all windows inside the pieces buf[start:end]."""
    none = np.zeros(0, np.int64)
    if len(buf) < width:
        return none, none, none
    h = seed_hashes(buf)
    key = (h & ~KEY_BITS) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(key, width - SEED + 1) & KEY_BITS).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int32)
    long = end - start >= width
    np.add.at(inside, start[long], 1)
    np.add.at(inside, end[long] - width + 1, -1)
    p = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(p):
        return none, none, none
    a = anchor[p]
    new = np.flatnonzero((np.diff(a) != 0) | (np.diff(p) != 1)) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(p)])) - 1
    return a[first], p[first], p[last]


def pieces(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, bytes]]:
    """Texts joined up to ``PIECE`` bytes: (ids, place of each piece in its document, length, bytes).

    A long text comes in pieces that overlap by all but one byte of a window, so that each window is in one piece.
    """
    give_back()
    ids, at, parts, size = [], [], [], 0
    for rows in batches:
        for doc, text, base in zip(rows.column(0).to_pylist(), rows.column(1).cast(pa.binary()), rows.column(2).to_pylist()):
            raw = memoryview(text.as_buffer()) if text.is_valid else b""
            for s in range(0, max(len(raw) - width + 1, 0), PIECE):
                part = raw[s : s + PIECE + width - 1]
                if size + len(part) > PIECE and parts:
                    yield ids, np.array(at), np.array([len(x) for x in parts]), b"".join(parts)
                    ids, at, parts, size = [], [], [], 0
                ids.append(doc)
                at.append(base + s)
                parts.append(part)
                size += len(part)
    if parts:
        yield ids, np.array(at), np.array([len(x) for x in parts]), b"".join(parts)


def suffixes(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(suffix, document, place of the anchor) in lots.  A suffix is: bytes from the anchor on, bytes before it, number of the former."""
    for ids, at, size, raw in pieces(batches, width):
        end = np.cumsum(size)
        start = end - size
        a, first, last = anchored(np.frombuffer(raw, np.uint8), start, end, width)
        which = np.searchsorted(end, a, side="right")
        reach = last + width
        made = [raw[m:e] + raw[f:m] + bytes((e - m,)) for m, f, e in zip(a.tolist(), first.tolist(), reach.tolist())]
        yield made, np.array(ids, np.int64)[which], at[which] + a - start[which]


# ---- front-coded runs ---------------------------------------------------------------------------------------------


def planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(raw: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<u8").ravel().astype(np.int64)


def pack_run(strings: list[bytes], doc: np.ndarray, at: np.ndarray) -> bytes:
    """Sorted distinct strings with their place, front-coded."""
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    lcp = np.zeros(len(strings), np.int64)
    rest = []
    wide = int(size.max(initial=1))
    columns = np.arange(wide)
    for lo in range(0, len(strings), 16384):
        hi = min(lo + 16384, len(strings))
        before = max(lo - 1, 0)
        m = np.array(strings[before:hi], dtype=f"S{wide}").view(np.uint8).reshape(hi - before, wide)
        differ = m[1:] != m[:-1]
        same = np.where(differ.any(1), differ.argmax(1), wide)
        lcp[before + 1 : hi] = np.minimum(same, np.minimum(size[before + 1 : hi], size[before : hi - 1]))
        m = m[lo - before :]
        rest.append(m[(columns >= lcp[lo:hi, None]) & (columns < size[lo:hi, None])].tobytes())
    least = int(doc.min())
    press = zstandard.ZstdCompressor(level=3).compress
    parts = [press(lcp.astype(np.uint8).tobytes() + size.astype(np.uint8).tobytes()), press(planes(doc - least) + planes(at)), press(b"".join(rest))]
    return HEAD.pack(len(strings), least, len(parts[0]), len(parts[1])) + b"".join(parts)


def open_run(raw: bytes) -> tuple[list[int], list[int], bytes, np.ndarray, np.ndarray]:
    """(shared prefix lengths, lengths, other bytes, documents, places)."""
    n, least, a, b = HEAD.unpack_from(raw)
    expand = zstandard.ZstdDecompressor().decompress
    o = HEAD.size
    coded, ids, rest = expand(raw[o : o + a]), expand(raw[o + a : o + a + b]), expand(raw[o + a + b :])
    return list(coded[:n]), list(coded[n:]), rest, unplanes(ids[: 8 * n], n) + least, unplanes(ids[8 * n :], n)


def sort_run(strings: list[bytes], doc: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct strings in order, index of the earliest place of each, indexes of the others)."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    ranked = [strings[i] for i in order]
    new = np.fromiter((a != b for a, b in zip(ranked, [None, *ranked])), bool, len(ranked))
    group = np.cumsum(new)
    order = np.array(order)
    by_place = np.lexsort((at[order], doc[order], group))
    head = np.concatenate(([True], np.diff(group[by_place]) > 0))
    place = order[by_place]
    return [s for s, n in zip(ranked, new) if n], place[head], place[~head], group


# ---- merge --------------------------------------------------------------------------------------------------------


def merge_runs(runs: list[bytes]) -> Iterator[tuple[bytes, int, int, int]]:
    """All strings of front-coded runs in order: (string, prefix shared with the one before, document, place).

    ``known[i]`` is what the head of run i shares with the last winner.  Heads that share more with it are smaller, and bytes are
    compared beyond the known prefix alone.
    """
    k = 1
    while k < len(runs):
        k *= 2
    opened = [open_run(r) for r in runs]
    lcps, sizes, rests = [x[0] for x in opened], [x[1] for x in opened], [x[2] for x in opened]
    docs, places = [x[3].tolist() for x in opened], [x[4].tolist() for x in opened]
    head: list[bytes] = [b""] * k
    known = [-1] * k  # below 0: the run has ended
    item, offset = [0] * k, [0] * k
    loser = [0] * k
    number = int.from_bytes

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads; the loser then knows what it shares with the winner."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        h = known[a]
        if h < 0:
            return a, b
        x, y = head[a], head[b]
        n = min(len(x), len(y))
        differ = number(x[h:n], "big") ^ number(y[h:n], "big")
        if differ:
            h = n - (differ.bit_length() + 7) // 8
            if x[h] < y[h]:
                known[b] = h
                return a, b
            known[a] = h
            return b, a
        if len(x) <= len(y):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    for i, r in enumerate(rests):
        if sizes[i]:
            head[i], known[i], offset[i] = r[: sizes[i][0]], 0, sizes[i][0]
    win = list(range(k)) * 2
    for node in range(k - 1, 0, -1):
        win[node], loser[node] = play(win[2 * node] if 2 * node < k else 2 * node - k, win[2 * node + 1] if 2 * node + 1 < k else 2 * node + 1 - k)
    w = win[1] if k > 1 else 0
    while known[w] >= 0:
        n = item[w]
        yield head[w], known[w], docs[w][n], places[w][n]
        n = item[w] = n + 1
        if n < len(sizes[w]):
            h, o = lcps[w][n], offset[w]
            stop = offset[w] = o + sizes[w][n] - h
            head[w] = head[w][:h] + rests[w][o:stop]
            known[w] = h
        else:
            known[w] = -1
        node = (w + k) >> 1
        while node:
            rival = loser[node]
            a, b = known[w], known[rival]
            if b > a:
                loser[node], w = w, rival
            elif a == b and a >= 0:
                w, loser[node] = play(w, rival)
            node >>= 1


def windows_of(suffix: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(bytes before the anchor, window) for every window of a suffix."""
    r = suffix[-1]
    right, left = suffix[:r], suffix[r:-1]
    for o in range(width - r, len(left) + 1):
        yield o, left[len(left) - o :] + right[: width - o]


def repeats_of_anchor(members: list[tuple[bytes, int, tuple[int, int]]], width: int) -> Iterator[tuple[int, int, int]]:
    """(document, start, end) of repeated windows among different suffixes of one anchor.

    ``members``: suffix, prefix shared with the next member, earliest place.  A window can only be in two of them
    if they share its bytes from the anchor on, so the longest prefix shared with a neighbour bounds what to look at.
    """
    first: dict[bytes, tuple[int, int]] = {}
    looked = []
    shared = 0
    for suffix, after, place in members:
        reach = max(shared, after)
        shared = after
        r = suffix[-1]
        right, left = suffix[:r], suffix[r:-1]
        n = len(left)
        for o in range(max(width - r, width - reach), n + 1):
            w = left[n - o :] + right[: width - o]
            looked.append((w, o, place))
            if w not in first or place < first[w]:
                first[w] = place
    for w, o, place in looked:
        if first[w] != place:
            yield place[0], place[1] - o, place[1] - o + width


# ---- the operator -------------------------------------------------------------------------------------------------

RUN_SCHEMA = "part int, kind int, run binary"
OUT_SCHEMA = "kind int, doc long, start long, end long, suffix binary"
SORTED, SPANS = 0, 1
SPAN, CUT = 1, 2


def _spans_row(part: int, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    order = np.lexsort((start, doc))
    doc, start, end = unite(doc[order], start[order], end[order])
    raw = struct.pack("<I", len(doc)) + zstandard.ZstdCompressor(level=3).compress(planes(doc - NO_ID) + planes(start) + planes(end))
    return part, SPANS, raw


def unite(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of ranges that touch; rows are sorted by document and start."""
    if not len(doc):
        return doc, start, end
    new = np.concatenate(([True], np.diff(doc) != 0))
    reach = end.copy()
    # The farthest end so far, document by document.
    for a, b in zip(np.flatnonzero(new), np.concatenate((np.flatnonzero(new)[1:], [len(doc)]))):
        np.maximum.accumulate(end[a:b], out=reach[a:b])
    begin = new.copy()
    begin[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(begin)
    return doc[first], start[first], reach[np.concatenate((first[1:], [len(doc)])) - 1]


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, raw = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(raw, pa.binary())], ["part", "kind", "run"])


def _runs(splitters: list[bytes], spread: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    strings: list[bytes] = []
    docs: list[np.ndarray] = []
    places: list[np.ndarray] = []
    parts = len(splitters) + 1
    turn = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal turn
        doc, at = np.concatenate(docs), np.concatenate(places)
        ranked, first, others, _ = sort_run(strings, doc, at)
        edges = [0, *[_lower(ranked, s) for s in splitters], len(ranked)]
        for part, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                yield _batch([(part, SORTED, pack_run(ranked[a:b], doc[first[a:b]], at[first[a:b]]))])
        if len(others):
            right = np.fromiter((strings[i][-1] for i in others), np.int64, len(others))
            size = np.fromiter((len(strings[i]) for i in others), np.int64, len(others)) - 1
            yield _batch([_spans_row(parts + (task + turn) % spread, doc[others], at[others] - (size - right), at[others] + right)])
        turn += 1
        strings.clear(), docs.clear(), places.clear()

    for made, doc, at in suffixes(batches, width):
        strings += made
        docs.append(doc)
        places.append(at)
        if len(strings) >= RUN:
            yield from flush()
    if strings:
        yield from flush()


def _lower(ranked: list[bytes], splitter: bytes) -> int:
    from bisect import bisect_left

    return bisect_left(ranked, splitter)


def _out(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["kind", "doc", "start", "end", "suffix"])
    return frame.astype({"kind": "int32", "doc": "int64", "start": "int64", "end": "int64"})


def _as_spans(doc: list[int], start: list[int], end: list[int]) -> pd.DataFrame:
    d, s, e = (np.array(x, np.int64) for x in (doc, start, end))
    order = np.lexsort((s, d))
    d, s, e = unite(d[order], s[order], e[order])
    return pd.DataFrame({"kind": np.full(len(d), SPAN, np.int32), "doc": d, "start": s, "end": e, "suffix": pd.Series([None] * len(d), dtype=object)})


def _merged(splitters: list[bytes], width: int, pdf: pd.DataFrame) -> pd.DataFrame:
    doc_, start_, end_ = [], [], []

    def span(d: int, s: int, e: int) -> None:
        doc_.append(d)
        start_.append(s)
        end_.append(e)

    for raw in pdf.run[pdf.kind == SPANS]:
        n = struct.unpack_from("<I", raw)[0]
        body = zstandard.ZstdDecompressor().decompress(raw[4:])
        d, s, e = (unplanes(body[8 * n * i : 8 * n * (i + 1)], n) for i in range(3))
        doc_ += (d + NO_ID).tolist()
        start_ += s.tolist()
        end_ += e.tolist()
    part = int(pdf.part.iloc[0])
    # Anchors that a splitter cuts have suffixes in other ranges too.
    cut = {s[:SEED] for s in splitters[max(part - 1, 0) : part + 1]}
    left: list[tuple] = []
    members: list[list] = []

    def anchor_ends() -> None:
        if members[0][0][:SEED] in cut:
            left.extend((CUT, d, a, 0, s) for s, _, (d, a) in members)
        elif len(members) > 1:
            for x in repeats_of_anchor(members, width):
                span(*x)

    for suffix, shared, doc, at in merge_runs(list(pdf.run[pdf.kind == SORTED])):
        if members and shared == len(suffix) == len(members[-1][0]):
            # The same suffix again: all windows of the later one are repeats.
            place = members[-1][2]
            later = max(place, (doc, at))
            members[-1][2] = min(place, (doc, at))
            r = suffix[-1]
            span(later[0], later[1] - (len(suffix) - 1 - r), later[1] + r)
            continue
        if members and shared >= SEED:
            members[-1][1] = shared
        elif members:
            anchor_ends()
            members = []
        members.append([suffix, 0, (doc, at)])
    if members:
        anchor_ends()
    frame = _as_spans(doc_, start_, end_)
    give_back()
    return pd.concat([frame, _out(left)]) if left else frame


def _window_runs(parts: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second exchange: the windows of cut anchors, sorted and front-coded; equal ones go to the same part."""
    lots: dict[int, list[tuple[bytes, int, int]]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for part, lot in lots.items():
            strings, doc, at = [x[0] for x in lot], np.array([x[1] for x in lot]), np.array([x[2] for x in lot])
            ranked, first, others, _ = sort_run(strings, doc, at)
            yield _batch([(part, SORTED, pack_run(ranked, doc[first], at[first]))])
            if len(others):
                yield _batch([_spans_row(part, doc[others], at[others], at[others] + width)])
        lots.clear()

    for rows in batches:
        for doc, at, suffix in zip(*(c.to_pylist() for c in rows.columns)):
            for o, w in windows_of(suffix, width):
                lots.setdefault(zlib.crc32(w) % parts, []).append((w, doc, at - o))
                held += 1
        if held >= RUN:
            yield from flush()
            held = 0
    yield from flush()


def _merged_windows(width: int, pdf: pd.DataFrame) -> pd.DataFrame:
    doc_, start_, end_ = [], [], []
    for raw in pdf.run[pdf.kind == SPANS]:
        n = struct.unpack_from("<I", raw)[0]
        body = zstandard.ZstdDecompressor().decompress(raw[4:])
        d, s, e = (unplanes(body[8 * n * i : 8 * n * (i + 1)], n) for i in range(3))
        doc_ += (d + NO_ID).tolist()
        start_ += s.tolist()
        end_ += e.tolist()
    before: tuple | None = None
    for w, shared, doc, at in merge_runs(list(pdf.run[pdf.kind == SORTED])):
        if before and shared == width:
            later = max(before, (doc, at))
            before = min(before, (doc, at))
            doc_.append(later[0])
            start_.append(later[1])
            end_.append(later[1] + width)
        else:
            before = (doc, at)
    return _as_spans(doc_, start_, end_)


def _sampled(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for made, _, _ in suffixes(batches, width):
        yield pa.RecordBatch.from_arrays([pa.array(made[::7], pa.binary())], ["suffix"])


def place_rows(df: DataFrame, key: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """(doc, text, base, [carried columns as c0, c1, ...]): base is where a row's text begins in its document; only rows that share an id need the window."""
    rows = df.select(F.coalesce(F.col(key), F.lit(NO_ID)).cast("long").alias("doc"), F.col(text).alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    if rows.groupBy("doc").count().filter("count > 1").isEmpty():
        return rows.withColumn("base", F.lit(0).cast("long"))
    order = Window.partitionBy("doc").orderBy("text").rowsBetween(Window.unboundedPreceding, -1)
    # One byte more than the text, so that spans of neighbouring rows never touch.
    return rows.withColumn("base", F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).over(order), F.lit(0)))


def repeated_spans(rows: DataFrame, width: int = 100) -> DataFrame:
    """(doc, start, end) of repeated bytes, for ``rows`` of ``place_rows``; spans may overlap."""
    if not 2 * SEED <= width <= 128:
        raise ValueError(f"width must lie between {2 * SEED} and 128")
    spark = rows.sparkSession
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(shuffle_width(spark), -(-total // RANGE_BYTES))
    some = rows.sample(min(1.0, SAMPLE / max(n, 1)), 7).mapInArrow(lambda it: _sampled(width, it), "suffix binary")
    sample = sorted({bytes(r.suffix) for r in some.collect()})
    splitters = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    spread = max(1, parts // 4)
    runs = rows.mapInArrow(lambda it: _runs(splitters, spread, width, it), RUN_SCHEMA)
    folder = scratch_path(spark, "suffix-spans")
    merged = runs.groupBy("part").applyInPandas(lambda pdf: _merged(splitters, width, pdf), OUT_SCHEMA)
    merged.write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    done = spark.read.schema(OUT_SCHEMA).parquet(folder)
    spans = done.filter(F.col("kind") == SPAN).select("doc", "start", "end")
    again = done.filter(F.col("kind") == CUT).select("doc", "start", "suffix")
    second = again.mapInArrow(lambda it: _window_runs(parts, width, it), RUN_SCHEMA)
    second = second.groupBy("part").applyInPandas(lambda pdf: _merged_windows(width, pdf), OUT_SCHEMA)
    return spans.unionByName(second.select("doc", "start", "end"))


def _kept(names: list[str], as_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        keys, texts, bases, spans = (rows.column(i) for i in range(4))
        kept, out = [], []
        for text, base, found in zip(texts.cast(pa.binary()).to_pylist(), bases.to_pylist(), spans.to_pylist()):
            text = text or b""
            cut: list[list[int]] = []
            for s, e in sorted((x["start"] - base, x["end"] - base) for x in found or ()):
                if e <= 0 or s >= len(text):
                    continue  # of another row with this id
                if cut and s <= cut[-1][1]:
                    cut[-1][1] = max(cut[-1][1], e)
                else:
                    cut.append([s, e])
            edge = [0, *(x for pair in cut for x in pair), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2])))
            out.append([{"start": s, "end": e} for s, e in cut])
        # A character of which only some bytes are left goes too.
        left = pa.array([b.decode(errors="ignore") for b in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        size = pa.array([len(t or b"") for t in texts.cast(pa.binary()).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([keys, *rows.columns[4:], size, left, pa.array(out, kind)], ["doc", *names, "n_bytes", "kept", "spans"])


def remove_repeats(df: DataFrame, width: int = 100, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), as_text: bool = False) -> DataFrame:
    """(key, [carry], n_bytes, kept, spans array<struct<start,end>>): what is left of each text and its maximal removed runs.

    ``kept`` is binary, or with ``as_text`` the whole characters that are left.
    """
    names = [f"c{i}" for i in range(len(carry))]
    carried = "".join(f", {n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, carry))
    rows = place_rows(df, key, text, carry)
    per_doc = repeated_spans(rows.select("doc", "text", "base"), width).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(per_doc, "doc", "left").select("doc", "text", "base", "spans", *names)
    out = joined.mapInArrow(lambda it: _kept(names, as_text, it), f"doc long{carried}, n_bytes long, kept {'string' if as_text else 'binary'}, spans array<struct<start:long,end:long>>")
    return out.select(F.nullif("doc", F.lit(NO_ID)).alias(key), *(F.col(n).alias(c) for n, c in zip(names, carry)), "n_bytes", "kept", "spans")


def digest(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256)."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return removed.select(key, "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def shorten(df: DataFrame, width: int = 100, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with what is left of their texts, with all their columns; ``length`` is counted anew where it is there.

    A character of which only some bytes are left goes too.  Null texts stay null.
    """
    names = df.columns
    plain = df.toDF(*(f"x{i}" for i in range(len(names))))
    k, t = f"x{names.index(key)}", f"x{names.index(text)}"
    left = remove_repeats(plain, width, k, t, carry=[c for c in plain.columns if c != k], as_text=True)
    new = F.when(F.size("spans") > 0, F.col("kept")).otherwise(F.col(t))
    left = left.withColumn(t, new)
    if length in names:
        n = f"x{names.index(length)}"
        left = left.withColumn(n, F.when(F.size("spans") > 0, F.length(t).cast(plain.schema[n].dataType)).otherwise(F.col(n)))
    return left.select(*(F.col(f"x{i}").alias(n) for i, n in enumerate(names)))

