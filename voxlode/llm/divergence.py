"""Quality by distribution divergence: character classes and common words of a document against references of its language.

References are learned from all documents that pass the base rules: per language the shares of the character classes, and the shares of
the ``COMMON`` most frequent words (lower case, punctuation taken off) and of all others together.  A document's histograms are
compared with them by the Jensen-Shannon distance (0 to 1).  A document goes if a distance exceeds its limit; the character
distance counts from ``least_chars`` characters on and the word distance from ``least_words`` words on, since histograms of short
texts are noise; for the same reason the limit of the squared word distance falls with the number of words, as the divergence
of a sample from its own source does.  A language without a reference (too few words, or null) is measured by the nearest reference; without
any reference only the base rules decide.

Base rules: fewer than 50 words, or more than half of the words in three-word windows that occur twice or more.

Null and empty texts have no words and fail the base rules.  Rows are judged one by one, so repeated rows get equal
results.  Repeated words are found by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .flat import Flat, flatten, mix, range_hashes, slices, text_bytes, window_hashes, words

COMMON = 100
#: Languages with a reference at most, those with most words first, and the words a reference needs.
LANGUAGES, REFERENCE_WORDS = 500, 5_000
MIN_WORDS = 50

CLASSES = ("lower", "upper", "digit", "space", "line", "point", "quote", "symbol", "other", "letter_lead", "rest")
LOWER, UPPER, DIGIT, SPACE, LINE, POINT, QUOTE, SYMBOL, OTHER, LEAD, REST = range(len(CLASSES))


def _byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), (b"0123456789", DIGIT), (b" \t\v\f\r", SPACE), (b"\n", LINE), (b".,;:", POINT), (b"!?'\"-()", QUOTE), (b"#*$%&|<>", SYMBOL)):
        table[list(chars)] = k
    table[0x80:0xC0] = REST
    table[0xC0:] = LEAD
    return table


BYTE_CLASS = _byte_classes()
#: Classes whose shares are compared; the bytes after the first of a character are not characters of their own.
COMPARED = [LOWER, UPPER, DIGIT, SPACE, LINE, POINT, QUOTE, SYMBOL, OTHER, LEAD]
#: Letters in lower case, everything else in ASCII as a space: words without punctuation.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Limits:
    char: float = 0.315
    word: float = 0.12
    word_noise: float = 28.0
    least_chars: int = 200
    least_words: int = 50

    def word_limit(self, n_words: np.ndarray) -> np.ndarray:
        return np.sqrt(self.word**2 + self.word_noise / (n_words + 45))


@dataclass
class Measures:
    classes: np.ndarray  # texts x classes
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    @property
    def base_failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > 50 * self.n_words)


def repeated_words(flat: Flat, begin: np.ndarray, stop: np.ndarray, first: np.ndarray, width: int = 3) -> np.ndarray:
    """Per text the number of words in windows of ``width`` words that the text has twice or more."""
    n = np.diff(first)
    text = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    h = window_hashes(range_hashes(flat.buf, begin, stop), width)
    if not len(h):
        return np.zeros(len(n), np.int64)
    inside = np.flatnonzero(text[: len(h)] == text[width - 1 :])
    key = h[inside] ^ mix(text[inside] + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(order) + 1, bool)
    again[1:-1] |= same
    again[:-2] |= same
    at = inside[order[again[:-1]]]
    hit = np.zeros(len(begin), bool)
    for k in range(width):
        hit[at + k] = True
    return np.bincount(text[hit].astype(np.int64), minlength=len(n))


def repeated_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.split()] if b"\n" in raw else ()
    return len(lines) - len(set(lines))


def measure(texts: list[bytes]) -> Measures:
    flat = flatten(texts)
    begin, stop, first = words(flat)
    size = flat.end - flat.start + 1
    k = len(CLASSES)
    classes = np.bincount(np.repeat(np.arange(len(texts)) * k, size) + BYTE_CLASS[flat.buf], minlength=k * len(texts)).reshape(-1, k)
    classes[:, LINE] -= 1  # the line feed between texts
    chars = classes.sum(1) - classes[:, REST] - classes[:, SPACE] - classes[:, LINE]
    lines = np.fromiter(map(repeated_lines, texts), np.int64, len(texts))
    return Measures(classes, np.diff(first), chars, classes[:, SYMBOL], lines, repeated_words(flat, begin, stop, first))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of every row of counts ``p`` and the counts ``q``: root of the divergence to base 2."""
    p = p / np.maximum(p.sum(-1, keepdims=True), 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


# ---- references ---------------------------------------------------------------------------------------------------


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) and, with the word null, (lang, class, n), for documents that pass the base rules."""
    held: dict[str | None, Counter] = {}

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.binary(), pa.int32(), pa.int64()))], ["lang", "word", "class", "n"])

    def flush() -> pa.RecordBatch:
        rows = [(lang, w, None, n) for lang, c in held.items() for w, n in c.items()]
        held.clear()
        return out(rows)

    for rows in slices(batches):
        texts, langs = text_bytes(rows.column(1)), rows.column(2).to_pylist()
        m = measure(texts)
        good = ~m.base_failed
        classes: dict[str | None, np.ndarray] = {}
        for i in np.flatnonzero(good).tolist():
            held.setdefault(langs[i], Counter()).update(texts[i].translate(PLAIN).split())
            classes[langs[i]] = classes.get(langs[i], 0) + m.classes[i]
        yield out([(lang, None, k, int(n)) for lang, c in classes.items() for k, n in enumerate(c)])
        if sum(map(len, held.values())) > 300_000:
            yield flush()
    yield flush()


@dataclass
class References:
    """Per language: counts of the character classes, common words, counts of these words and of all others."""

    classes: dict[str, np.ndarray]
    common: dict[str, list[bytes]]
    word_counts: dict[str, np.ndarray]


def learn_references(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> References:
    """What reaches the driver is ``COMMON`` words for each of ``LANGUAGES`` languages at most."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counted = rows.mapInArrow(_counts, "lang string, word binary, class int, n long").filter("lang IS NOT NULL")
    totals = counted.groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    sums = totals.filter("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("words")).filter(F.col("words") >= REFERENCE_WORDS)
    sums = sums.orderBy(F.desc("words"), "lang").limit(LANGUAGES)
    # The rank filter stands alone, so that each task passes on the best words of a language only.
    best = totals.filter("word IS NOT NULL").select("lang", "word", "class", "n", place.alias("place")).filter(F.col("place") <= COMMON).drop("place")
    kept = best.unionByName(totals.filter("word IS NULL")).join(sums, "lang")
    refs = References({}, {}, {})
    for r in sorted(kept.collect(), key=lambda r: (r["lang"], -r["n"], r["word"] or b"")):
        if r["word"] is None:
            refs.classes.setdefault(r["lang"], np.zeros(len(CLASSES)))[r["class"]] = r["n"]
        else:
            refs.common.setdefault(r["lang"], []).append(bytes(r["word"]))
            refs.word_counts.setdefault(r["lang"], [r["words"]]).append(r["n"])
    for name, n in refs.word_counts.items():
        refs.word_counts[name] = np.array([*n[1:], n[0] - sum(n[1:])], float)
    return refs


# ---- verdict ------------------------------------------------------------------------------------------------------


def distances(texts: list[bytes], langs: list, m: Measures, refs: References) -> tuple[np.ndarray, np.ndarray]:
    """(character distance, word distance) of every text to its language's reference, or else to the nearest."""
    n = len(texts)
    char, word = np.full(n, 2.0), np.full(n, 2.0)
    plain = [Counter(t.translate(PLAIN).split()) for t in texts]
    total = np.fromiter((sum(c.values()) for c in plain), float, n)
    for name in refs.common:
        own = np.fromiter((x == name or x not in refs.common for x in langs), bool, n)
        at = np.flatnonzero(own)
        if not len(at):
            continue
        char[at] = np.minimum(char[at], js_distance(m.classes[at][:, COMPARED], refs.classes[name][COMPARED]))
        hist = np.array([[plain[i].get(w, 0) for w in refs.common[name]] for i in at], float).reshape(len(at), -1)
        hist = np.column_stack((hist, total[at] - hist.sum(1)))
        word[at] = np.minimum(word[at], js_distance(hist, refs.word_counts[name]))
    char[char > 1.5] = 0
    word[word > 1.5] = 0
    return char, word


RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept")
RESULT_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean"


def judge(df: DataFrame, refs: References, limits: Limits | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang", carry: Sequence[str] = ()) -> DataFrame:
    """(key, [carry], measures, distances, kept) of every document."""
    limits = limits or Limits()
    names = ["key", *(f"c{i}" for i in range(len(carry)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            texts = text_bytes(rows.column(1))
            m = measure(texts)
            char, word = distances(texts, rows.column(2).to_pylist(), m, refs)
            chars = m.word_chars + m.classes[:, SPACE] + m.classes[:, LINE]
            far = ((char > limits.char) & (chars >= limits.least_chars)) | ((word > limits.word_limit(m.n_words)) & (m.n_words >= limits.least_words))
            out = [m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed, char, word, ~m.base_failed & ~far]
            yield pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[3:], *(pa.array(x) for x in out)], [*names, *RESULT])

    schema = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, [key, *carry]))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    out = rows.mapInArrow(run, f"{schema}, {RESULT_SCHEMA}")
    return out.select(F.col("key").alias(key), *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), *RESULT)
