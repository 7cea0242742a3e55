"""Byte-level BPE, encoding and decoding.

The pre-tokens of a slice of rows are merged together: in every round each of them merges its first pair of lowest rank,
in numpy, until it has none.  A long pre-token becomes a doubly linked list of symbols instead; a priority queue of (merge
rank, place) gives the next merge, and entries whose symbols have changed meanwhile are skipped.  Decoding concatenates
vocabulary strings.

Merges never cross pre-token borders, and a space after a character that is no white space is such a border.  So texts are
cut at spaces, equal pieces are merged once per slice of rows, and numpy puts the results of the pieces together; texts
with white space before a space go through the pattern as a whole.

Null and empty texts have no ids and decode to the empty text.  A special token's string inside a text is that token.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .flat import CACHES, slices

#: Fixed value: the public pre-token pattern of the vocabulary, with white space as a Unicode property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Texts that match are not cut at spaces.
UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
#: Pieces that match are one pre-token; letters that every version of Unicode has.
ONE_TOKEN = r"^ ?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+$"
#: Bytes of a pre-token from which it is merged by itself.
LONG = 64
#: No pair of symbols has this rank.
NONE = np.iinfo(np.int32).max
#: Text bytes in a lot: the more, the more pieces are equal.
LOT_BYTES = 3 << 20
#: Ids whose strings are put together at once, or those of one text.
JOINED = 1 << 18


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class BytePairs:
    """Vocabulary and merge ranks of a tokenizer file, read once per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merges = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.of_byte = [vocab[c] for c in letters]
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        strings = [self.strings.get(i, b"") for i in range(max(self.strings) + 1)]
        self.bytes_of = pa.array(strings, pa.large_binary())
        self.digits_of = pa.array(map(str, range(len(strings))), pa.large_binary())
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.unsafe = UNSAFE + "".join("|" + regex.escape(s) for s in self.special)
        self.byte_ids = np.array(self.of_byte, np.int32)
        # Pairs as sorted numbers, with a last one that is no pair.
        self.base = max(vocab.values()) + 1
        named = sorted((a * self.base + b, rank, new) for (a, b), (rank, new) in self.merges.items())
        self.pair_names = np.array([p for p, _, _ in named] + [np.iinfo(np.int64).max])
        self.pair_ranks = np.array([r for _, r, _ in named] + [NONE], np.int32)
        self.made = np.zeros(len(spec["model"]["merges"]), np.int32)
        self.made[self.pair_ranks[:-1]] = [n for _, _, n in named]
        self.byte_ranks = self.ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair of symbols."""
        name = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.pair_names, name)
        return np.where(self.pair_names[at] == name, self.pair_ranks[at], NONE)

    def merge_all(self, tokens: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per token) of pre-tokens; none of them is empty or null."""
        if not len(tokens):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        border = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
        raw = np.frombuffer(tokens.buffers()[2], np.uint8)[border[0] : border[-1]]
        edge, size = border[:-1] - border[0], np.diff(border)
        out = np.full(len(raw), -1, np.int32)
        long = size >= LONG
        for i in np.flatnonzero(long).tolist():
            ids = self.merge(raw[edge[i] : edge[i] + size[i]].tobytes())
            out[edge[i] : edge[i] + len(ids)] = ids
        place = np.flatnonzero(np.repeat(~long, size))
        raw, left = raw[place], size[~long]
        symbol = self.byte_ids[raw]
        rank = np.full(len(raw), NONE, np.int32)
        rank[:-1] = self.byte_ranks[raw[:-1].astype(np.int32) * 256 + raw[1:]]
        rank[np.cumsum(left) - 1] = NONE
        while len(left):
            start = np.cumsum(left) - left
            best = np.minimum.reduceat(rank, start)
            go = best != NONE
            if not go.all():
                stay = np.repeat(go, left)
                out[place[~stay]] = symbol[~stay]
                symbol, rank, place, left, best = symbol[stay], rank[stay], place[stay], left[go], best[go]
                if not len(left):
                    break
                start = np.cumsum(left) - left
            hit = np.flatnonzero(rank == np.repeat(best, left))
            at = hit[np.searchsorted(hit, start)]
            symbol[at] = self.made[best]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, rank, place = symbol[keep], rank[keep], place[keep]
            # Every token before has lost one symbol as well.
            gone = np.arange(len(at))
            at, start, left = at - gone, start - gone, left - 1
            inner = at + 1 < start + left
            rank[at] = NONE
            rank[at[inner]] = self.ranks(symbol[at[inner]], symbol[at[inner] + 1])
            inner = at[at > start]
            rank[inner - 1] = self.ranks(symbol[inner - 1], symbol[inner])
        found = out >= 0
        return out[found], np.add.reduceat(found, edge, dtype=np.int64)

    def merge(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        merges = self.merges
        ids = [self.of_byte[b] for b in token]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapify(queue)
        while queue:
            _, i, new, left, right = heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of its symbols is gone or has grown
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((new, ids[k])):
                    heappush(queue, (m[0], i, m[1], new, ids[k]))
            if (p := before[i]) >= 0 and (m := merges.get((ids[p], new))):
                heappush(queue, (m[0], p, m[1], ids[p], new))
        return [i for i in ids if i >= 0]

    def tokens(self, text: str) -> list[str]:
        """Pre-tokens and special tokens of a text."""
        parts = self.cut.split(text) if self.cut else [text]
        return [t for i, part in enumerate(parts) for t in ([part] if i % 2 else self.pattern.findall(part))]

    def encode_all(self, pieces: pa.LargeStringArray, whole: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece); only the last ``whole`` pieces can hold a special token."""
        one = np.array(pc.match_substring_regex(pieces, ONE_TOKEN))
        one[len(one) - whole :] = False
        rest = pieces.filter(pa.array(~one)).to_pylist()
        plain = len(rest) - whole
        parts = [*map(self.pattern.findall, rest[:plain]), *map(self.tokens, rest[plain:])]
        count = np.ones(len(one), np.int64)
        count[~one] = np.fromiter(map(len, parts), np.int64, len(parts))
        singles = pieces.filter(pa.array(one))
        coded = pa.concat_arrays([singles, pa.array([*chain.from_iterable(parts)], pa.large_string())]).dictionary_encode()
        ids, size = self.merge_all(coded.dictionary)
        for name, i in self.special.items() if whole else ():
            if (k := coded.dictionary.index(name).as_py()) >= 0:
                begin = int(size[:k].sum())
                ids = np.concatenate((ids[:begin], [i], ids[begin + size[k] :])).astype(np.int32)
                size[k] = 1
        found = np.asarray(coded.indices)
        code = np.empty(len(found), np.int64)
        alone = np.repeat(one, count)
        code[alone], code[~alone] = found[: len(singles)], found[len(singles) :]
        ids, edge = expand(ids, size, code, np.concatenate(([0], np.cumsum(count))))
        return ids, np.diff(edge)

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.large_string()), 1)[0].tolist()

    def decode(self, ids) -> bytes:
        strings = self.strings
        return b"".join([strings[i] for i in ids])


@lru_cache(maxsize=4)
def codec(path: str) -> BytePairs:
    return BytePairs(path)


CACHES["bpe"] = codec.cache_clear


def cut_pieces(texts: pa.Array, unsafe: str) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """(pieces, code, offset, whole): distinct pieces, and each text as codes into them.  The pieces of text i are
    code[offset[i]:offset[i + 1]].  Pieces after the first of a text begin with the space before them.
    The last ``whole`` pieces are texts that were not cut; only these can hold a special token."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    whole = np.asarray(pc.match_substring_regex(texts, unsafe))
    parts = pc.split_pattern(pc.if_else(pa.array(~whole), texts, ""), " ")
    offset = np.asarray(parts.offsets).astype(np.int64)
    offset -= offset[0]
    coded = parts.flatten().dictionary_encode()
    code = np.asarray(coded.indices).astype(np.int64)
    plain, first = len(coded.dictionary), offset[:-1]
    code[first] += plain
    if whole.any():
        at = np.flatnonzero(whole)
        code[first[at]] = 2 * plain + np.arange(len(at))
    seen = np.zeros(2 * plain + np.count_nonzero(whole), bool)
    seen[code] = True
    used = np.flatnonzero(seen)
    code = (np.cumsum(seen) - 1)[code]
    tail = used[used < plain]
    head = used[(used >= plain) & (used < 2 * plain)] - plain
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), coded.dictionary.take(pa.array(tail)), pa.scalar(" ", pa.large_string()))
    pieces = [spaced, coded.dictionary.take(pa.array(head)), texts.filter(pa.array(whole))]
    return pa.concat_arrays([p.cast(pa.large_string()) for p in pieces]), code, offset, int(np.count_nonzero(whole))


def encode_column(texts: pa.Array, pairs: BytePairs) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text begins."""
    pieces, code, offset, whole = cut_pieces(texts, pairs.unsafe)
    return expand(*pairs.encode_all(pieces, whole), code, offset)


def _encoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches, LOT_BYTES, "bpe"):
        ids, edge = encode_column(rows.column(1), codec(path))
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids))], ["key", "ids"])


def expand(flat: np.ndarray, size: np.ndarray, code: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text begins; ``flat`` holds ``size[c]`` ids of every piece c."""
    begin = np.cumsum(size) - size
    n = size[code]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[code] - (ends - n), n)
    return flat[at], np.concatenate(([0], ends))[offset]


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every text; other columns are not carried."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    return rows.mapInArrow(lambda it: _encoded(path, it), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of every list of ids; a null list is the empty text, bytes that are no UTF-8 become U+FFFD."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = codec(path)
        for rows in batches:
            texts = [pairs.decode(x or []).decode(errors="replace") for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], ["key", "text"])

    return df.select(df[key].alias("key"), df[ids].alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def _digests(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = codec(path)
    for rows in slices(batches, LOT_BYTES, "bpe"):
        ids, edge = encode_column(rows.column(1), pairs)
        # A few texts at a time: what is joined takes more room than the texts.
        lots = [0, *np.searchsorted(edge, np.arange(JOINED, edge[-1], JOINED)).tolist(), len(edge) - 1]
        digests: list[list[str]] = [[], []]
        for a, b in zip(lots, lots[1:]):
            at, border = pa.array(ids[edge[a] : edge[b]]), pa.array(edge[a : b + 1] - edge[a])
            join = lambda strings, between: pc.binary_join(pa.LargeListArray.from_arrays(border, strings.take(at)), pa.scalar(between, pa.large_binary()))  # noqa: B023, E731
            digests[0] += [hashlib.sha256(v.as_buffer()).hexdigest() for v in join(pairs.digits_of, b",")]
            digests[1] += [hashlib.sha256(valid(v.as_buffer())).hexdigest() for v in join(pairs.bytes_of, b"")]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(edge)), *map(pa.array, digests)], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])


def valid(raw) -> bytes:
    """The bytes as UTF-8 text: wrong sequences become U+FFFD."""
    return bytes(raw).decode(errors="replace").encode()


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: (key, n_tokens, ids_sha256, decoded_sha256).

    The same as ``encode`` and ``decode`` one after the other, without id lists that travel between them.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    out = rows.mapInArrow(lambda it: _digests(path, it), f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
