"""Texts of an Arrow batch as one byte array, and word arithmetic on it with numpy.

All helpers work on whole texts, keep document borders, and take nulls as empty texts.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The separators of words: space and the five control characters from tab to carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
PRIME = 0x9E3779B97F4A7C15
INVERSE = pow(PRIME, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


@dataclass
class Flat:
    """Bytes of several texts, a line feed after each; text i is buf[start[i]:end[i]]."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray


def text_bytes(texts: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in texts.cast(pa.binary()).to_pylist()]


def flatten(texts: list[bytes]) -> Flat:
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    end = np.cumsum(size + 1) - 1
    return Flat(np.frombuffer(b"\n".join([*texts, b""]), np.uint8), end - size, end)


def slices(batches: Iterator[pa.RecordBatch], most: int = 2 << 20, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most`` text bytes; column 1 is the text.  ``keep`` names the cache that the next task will use again."""
    give_back(keep)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.cumsum(sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
    give_back(keep)


#: What operators keep in a worker from task to task, and how to drop it.
CACHES: dict[str, Callable[[], None]] = {}


def give_back(keep: str = "") -> None:
    """Drop caches but ``keep`` and return freed memory to the system: a Python worker is used again by later stages, which need it for other things."""
    for name, drop in CACHES.items():
        if name != keep:
            drop()
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    upper = (buf >= 65) & (buf <= 90)
    return buf + upper.astype(np.uint8) * np.uint8(32)


def byte_table(separators) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


SPACE_TABLE = byte_table(SPACES)


def words(flat: Flat, separator: np.ndarray = SPACE_TABLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of every word; words of text i are first[i] up to first[i + 1]."""
    inside = ~separator[flat.buf]
    change = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    begin, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    first = np.concatenate((np.searchsorted(begin, flat.start), [len(begin)]))
    return begin, stop, first


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 << 20:  # those of a very long text aren't kept
            _POWERS[name] = have
    return have[:n]


def range_sums(buf: np.ndarray) -> np.ndarray:
    """What ``range_hashes`` takes of the bytes; ranges of several kinds can share it."""
    n = len(buf) + 1
    total = np.empty(n, np.uint64)
    total[0] = 0
    weighed = np.add(buf, np.uint64(1), out=total[1:])
    weighed *= _powers("up", PRIME, n)[1:]
    np.cumsum(weighed, out=weighed)
    return total


def range_hashes(buf: np.ndarray, begin: np.ndarray, stop: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every byte range, equal for equal bytes wherever they stand."""
    if total is None:
        total = range_sums(buf)
    h = (total[stop] - total[begin]) * _powers("down", INVERSE, len(buf) + 1)[begin]
    return mix(h + (stop - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours in ``h``."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    n = len(h) - width + 1
    out = h[:n].copy()
    for i in range(1, width):
        out = out * np.uint64(PRIME) + h[i : i + n]
    return mix(out)
