"""Rules applied to texts through one lookup of all their words (``terms.py``).

A lexicon's words, and a literal that each pattern needs, are looked up in a batch of texts together; what is found leads to rules by
their tables of words.  A pattern is tried only on texts that hold its literal; patterns without an evident one are tried on
all texts.  Patterns are read as Spark reads them: ``\\w``, ``\\d`` and ``\\s`` mean ASCII, ``\\p{L}`` all letters.  A lexicon of more than ``PART_BYTES`` of words is taken in parts,
each one pass over the texts, so what a task holds stays bounded at any number of rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import Rule
from ..patterns import ascii_classes
from .terms import WordIndex, required_literal

PART_BYTES = 16 << 20
#: Bytes of text taken together, and of rows handed on together.
LOT_BYTES = 1 << 20
ROLES = ("keywords", "exclude", "context", "relevance")


class Compiled:
    """Words and patterns of some rules, as tables from words to rules; with ``lower``, for lower-cased texts."""

    def __init__(self, rules: Sequence[Rule], lower: bool, shared: dict[str, Sequence[str]] | None = None):
        self.n = max(1, len(rules))
        low = (lambda w: w.lower()) if lower else (lambda w: w)
        words = {role: [list(dict.fromkeys(map(low, getattr(r, role)))) for r in rules] for role in ROLES}
        self.patterns = [(i, p) for i, r in enumerate(rules) for p in r.patterns]
        literals = [required_literal(p) for _, p in self.patterns]
        self.shared = {name: list(w) for name, w in (shared or {}).items()}
        every = [w for lists in words.values() for ws in lists for w in ws] + [x for x in literals if x] + [w for ws in self.shared.values() for w in ws]
        self.index = WordIndex(every)
        self.tables = {role: self._table([self.index.of(ws) for ws in lists]) for role, lists in words.items()}
        self.tables["literals"] = self._table([self.index.of([x]) if x else [] for x in literals])
        self.anywhere = [k for k, x in enumerate(literals) if not x]
        self.flags = {name: np.isin(np.arange(len(self.index.words)), self.index.of(ws)) for name, ws in self.shared.items()}

    def _table(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(where each word's owners start, owners)."""
        word = np.array([w for ws in lists for w in ws], np.int64)
        owner = np.repeat(np.arange(len(lists)), [len(ws) for ws in lists])
        order = np.argsort(word, kind="stable")
        return np.searchsorted(word[order], np.arange(len(self.index.words) + 1)), owner[order]


class Found:
    """What was found in a batch.  A code stands for a text and a rule: text * number of rules + rule."""

    def __init__(self, lexicon: Compiled, texts: list[bytes]):
        self.lexicon, self.texts = lexicon, texts
        self.text, self.word, self.times = lexicon.index.counts(texts)

    def _owners(self, role: str, width: int) -> tuple[np.ndarray, np.ndarray]:
        first, owner = self.lexicon.tables[role]
        n = first[self.word + 1] - first[self.word]
        at = np.repeat(first[self.word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.repeat(self.text, n) * width + owner[at], np.repeat(self.times, n)

    def codes(self, role: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, words of the role that are present, their occurrences)."""
        code, times = self._owners(role, self.lexicon.n)
        code, back, n = np.unique(code, return_inverse=True, return_counts=True)
        return code, n, np.bincount(back.ravel(), times, len(code)).astype(np.int64)

    def matched(self) -> np.ndarray:
        """Code of every pattern that matches, one for each pattern."""
        lexicon = self.lexicon
        width = max(1, len(lexicon.patterns))
        pairs = np.unique(self._owners("literals", width)[0])
        if lexicon.anywhere:
            pairs = np.concatenate((pairs, (np.arange(len(self.texts))[:, None] * width + np.array(lexicon.anywhere)).ravel()))
        text: dict[int, str] = {}
        out = []
        for pair in pairs.tolist():
            t, k = divmod(pair, width)
            if t not in text:
                text[t] = self.texts[t].decode()
            rule, pattern = lexicon.patterns[k]
            if _searcher(pattern)(text[t]):
                out.append(t * lexicon.n + rule)
        return np.array(out, np.int64)

    def flagged(self, name: str) -> np.ndarray:
        """Does a text hold any of the shared words ``name``?"""
        out = np.zeros(len(self.texts), bool)
        out[self.text[self.lexicon.flags[name][self.word]]] = True
        return out


_SEARCH: dict[str, Callable] = {}


def _searcher(pattern: str) -> Callable:
    if pattern not in _SEARCH:
        _SEARCH[pattern] = regex.compile(ascii_classes(pattern)).search
    return _SEARCH[pattern]


def lookup(codes: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Value of each wanted code, 0 if it isn't there; ``codes`` are sorted."""
    if not len(codes):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, values[at], 0)


#: Judges a batch: (text of each row that comes out, its columns).
Judge = Callable[[Found, pa.RecordBatch, int], tuple[np.ndarray, list[pa.Array]]]


def parts_of(rules: Sequence[Rule]) -> Iterator[tuple[int, Sequence[Rule]]]:
    """(number of the first rule, rules) in parts of bounded size."""
    first, size = 0, 0
    for i, r in enumerate(rules):
        own = sum(len(w.encode()) for role in (*ROLES, "patterns") for w in getattr(r, role))
        if size and size + own > PART_BYTES:
            yield first, rules[first:i]
            first, size = i, 0
        size += own
    yield first, rules[first:]


def _ranges(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbours of about ``LOT_BYTES`` together."""
    cut = np.cumsum(size) // LOT_BYTES
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(size)]
    return zip(edges, edges[1:])


def _row_bytes(columns: Sequence[pa.Array], n: int) -> np.ndarray:
    size = np.full(n, 32, np.int64)
    for c in columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        else:
            size += c.nbytes // n
    return size


def _lots(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    for a, b in _ranges(_row_bytes([batch.column(at)], batch.num_rows)):
        yield batch.slice(a, b - a)


def pieces(rows: Sequence[pa.Array], at: np.ndarray, columns: Sequence[pa.Array]) -> Iterator[list[pa.Array]]:
    """The rows ``at`` beside ``columns``, about ``LOT_BYTES`` at a time."""
    for a, b in _ranges(_row_bytes(rows, len(rows[0]) if rows else int(at.max(initial=0)) + 1)[at]):
        own = pa.array(at[a:b], pa.int64())
        yield [*(c.take(own) for c in rows), *(c.slice(a, b - a) for c in columns)]


def scan(df: DataFrame, text: Column, rules: Sequence[Rule], fields: str, judge: Judge, lower: bool = False, shared: dict[str, Sequence[str]] | None = None, measures: Sequence[Column] = (), carry: Sequence[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (by default all) and ``fields`` for every (text, rule) that ``judge`` lets through.

    ``measures`` are further columns that ``judge`` reads behind the text.  A null text matches nothing.  What matches is handed on in
    pieces of bounded size, however many rules a text meets.
    """
    carried = list(df.columns if carry is None else carry)
    names = [f"c{i}" for i in range(len(carried))]
    plain = df.select(*(F.col(f"`{c}`") for c in carried)).toDF(*names)
    # Expressions over the given names, then positions.
    every = df.select(*(F.col(f"`{c}`") for c in carried), text.alias("_scan_text"), *(m.alias(f"_scan_{i}") for i, m in enumerate(measures)))
    every = every.toDF(*names, "t", *(f"m{i}" for i in range(len(measures)))).filter("t is not null")
    schema = ", ".join([f"{n} {plain.schema[n].dataType.simpleString()}" for n in names] + [fields])
    added = [f.strip().split(" ")[0] for f in fields.split(",")]
    width = len(names)
    out = None
    for first, part in parts_of(rules):
        held = df.sparkSession.sparkContext.broadcast(Compiled(part, lower, shared))

        def run(batches: Iterator[pa.RecordBatch], held=held, first=first) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in _lots(batch, width) if batch.num_rows else ():
                    found = Found(held.value, rows.column(width).cast(pa.binary()).to_pylist())
                    at, columns = judge(found, rows, first)
                    for piece in pieces(rows.columns[:width], at, columns):
                        yield pa.RecordBatch.from_arrays(piece, [*names, *added])

        one = every.mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    return out.toDF(*carried, *added)
