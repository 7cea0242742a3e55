"""Many words looked up in many texts at once, with numpy.

A batch's texts lie in one byte array.  The eight bytes at every place are read as a number; words of one to seven bytes are compared with
as many of them, longer ones with all eight first and with the rest where those agree.  A small table of hashed beginnings tells
most places that no word starts there.  So the work for a text doesn't depend on the number of words, and overlapping words are all found.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Parts texts; no UTF-8 text has it.
BORDER = b"\xff"
#: Places looked at together.
LOT = 2 << 20


def eights(raw: bytes) -> np.ndarray:
    """The number in the eight bytes from every place on."""
    n = len(raw)
    padded = raw + bytes(16)
    out = np.empty((n + 7) // 8 * 8, np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(padded, "<u8", len(out) // 8, k)
    return out[:n]


def has_border(word: bytes) -> bool:
    """Can two occurrences of the word overlap?"""
    return any(word.endswith(word[:k]) for k in range(1, len(word)))


class WordIndex:
    """Distinct words and how to find them; empty words are found nowhere."""

    def __init__(self, words: Sequence[str]):
        self.words = sorted({w.encode() for w in words if w})
        self.number = {w: i for i, w in enumerate(self.words)}
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.overlaps = np.array([has_border(w) for w in self.words], bool)
        self.longest = int(self.size.max(initial=0))
        head = np.array([int.from_bytes(w[:8], "little") for w in self.words], np.uint64)
        #: Per length (8: that or more): (mask, bits of the table, table, sorted heads, their words in a row, where each head's words start).
        self.classes = []
        for c in range(1, 9):
            own = np.flatnonzero(np.minimum(self.size, 8) == c)
            if not len(own):
                continue
            own = own[np.argsort(head[own], kind="stable")]
            keys, first = np.unique(head[own], return_index=True)
            bits = int(min(20, max(10, len(keys).bit_length() + 4)))
            table = np.zeros(1 << bits, bool)
            table[keys * PRIME >> np.uint64(64 - bits)] = True
            mask = np.uint64((1 << 8 * c) - 1) if c < 8 else np.uint64(2**64 - 1)
            self.classes.append((mask, np.uint64(64 - bits), table, keys, own, np.append(first, len(own))))
        # Beyond eight bytes: the number at each further step of eight, the last one ending with the word.
        self.steps = []
        for at in range(8, self.longest, 8):
            want = np.zeros(len(self.words), np.uint64)
            where = np.full(len(self.words), -1, np.int64)
            for i in np.flatnonzero(self.size > at).tolist():
                k = min(at, len(self.words[i]) - 8)
                where[i], want[i] = k, int.from_bytes(self.words[i][k : k + 8], "little")
            self.steps.append((where, want))

    def of(self, words: Sequence[str]) -> list[int]:
        return [self.number[w.encode()] for w in words if w]

    def _places(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(word, place) of all occurrences."""
        v = eights(raw)
        words, places = [], []
        for mask, shift, table, keys, own, first in self.classes:
            masked = v & mask
            at = np.flatnonzero(table[masked * PRIME >> shift])
            found = masked[at]
            k = np.searchsorted(keys, found)
            ok = keys[np.minimum(k, len(keys) - 1)] == found
            at, k = at[ok], k[ok]
            n = first[k + 1] - first[k]
            at = np.repeat(at, n)
            word = own[np.repeat(first[k] - (np.cumsum(n) - n), n) + np.arange(len(at))]
            for where, want in self.steps if mask == np.uint64(2**64 - 1) else ():
                longer = where[word] >= 0
                if not longer.any():
                    break
                there = np.minimum(at + np.maximum(where[word], 0), len(v) - 1)
                ok = ~longer | (v[there] == want[word])
                at, word = at[ok], word[ok]
            words.append(word)
            places.append(at)
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(words), np.concatenate(places)

    def counts(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, word, times) of every word in every text, in this order; occurrences that overlap an earlier one of the same word don't count."""
        end = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        raw = BORDER.join([*texts, b""])
        words, places = [], []
        for a in range(0, len(raw), LOT):
            w, p = self._places(raw[a : a + LOT + self.longest + 8])
            ok = p < LOT
            words.append(w[ok])
            places.append(p[ok] + a)
        word = np.concatenate(words) if words else np.zeros(0, np.int64)
        place = np.concatenate(places) if places else word
        text = np.searchsorted(end, place, side="right")
        # Words never reach over a border, since they don't hold it.
        order = np.lexsort((place, word, text))
        text, word, place = text[order], word[order], place[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (word[1:] != word[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(text)))
        for r in np.flatnonzero(self.overlaps[word[first]] & (times > 1)).tolist():
            free, n = -1, 0
            for x in place[first[r] : first[r] + times[r]].tolist():
                if x >= free:
                    free, n = x + int(self.size[word[first[r]]]), n + 1
            times[r] = n
        return text[first], word[first], times


def required_literal(pattern: str) -> str | None:
    """A longest run of characters that every match of the pattern holds, None if none is evident.

    Groups, classes and escapes of letters end a run, a quantifier takes the character before it away; an alternation, a flag or anything unclear
    at the top gives none.
    """
    runs, run, i = [], "", 0
    while i < len(pattern):
        c = pattern[i]
        step, literal = 1, None
        if c == "|" or pattern.startswith("(?", i) and not pattern.startswith("(?:", i):
            return None
        if c == "\\":
            step = 2
            if i + 1 >= len(pattern):
                return None
            if pattern[i + 1].isalnum():
                step = _braced(pattern, i + 2) - i if pattern[i + 1] in "pPx" else 2
            else:
                literal = pattern[i + 1]
        elif c in "[(":
            step = _closing(pattern, i) - i
            if step <= 0:
                return None
        elif c in ".^$":
            pass
        elif c in ")]{}*+?":
            return None
        else:
            literal = c
        quantifier = pattern[i + step : i + step + 1]
        if literal is None or quantifier in ("*", "?", "{"):
            runs.append(run)
            run = ""
        elif quantifier == "+":
            runs.append(run + literal)
            run = ""
        else:
            run += literal
        i += step
        if quantifier and quantifier in "*?+{":
            i = _braced(pattern, i) if quantifier == "{" else i + 1
            if pattern[i : i + 1] in ("?", "+"):
                i += 1
    best = max([*runs, run], key=len)
    return best or None


def _braced(pattern: str, i: int) -> int:
    return pattern.index("}", i) + 1 if pattern[i : i + 1] == "{" and "}" in pattern[i:] else i + 1


def _closing(pattern: str, i: int) -> int:
    """The place behind the bracket that closes the one at ``i``; 0 if there is none."""
    depth, in_class = 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 2
            continue
        if in_class:
            in_class = c != "]"
            depth -= c == "]"
        elif c == "[":
            in_class = True
            depth += 1
            if pattern[i + 1 : i + 2] in ("^", "]"):
                i += 1 + (pattern[i + 1 : i + 3] == "^]")
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        i += 1
        if not depth:
            return i
    return 0
