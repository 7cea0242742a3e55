"""Phrases, license scans and vector codes against brute force, with all awkward cases."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.test_operators import as_counter, lowered
from voxlode.llm import licenses, phrases, vector_codes

# ---- 11 -----------------------------------------------------------------------------------------------------------


def brute_phrases(rows, least, top, percent=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    f = {p: a for p, a in f.items() if a >= least}
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) == 1:
            continue
        if any(q != p and lang == other and len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (other, q), b in f.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, b" ".join(p), left, right))
    return Counter((lang, rank, p.decode(), -a, le, ri, n[lang], -s) for lang, x in out.items() for rank, (s, a, p, le, ri) in enumerate(sorted(x)[:top], 1))


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize(("least", "top"), [(2, 50), (30, 2000)])
def test_phrases(docs, least, top):
    got = phrases.collocations(*phrases.count_phrases(docs, least), top)
    want = brute_phrases([(r.lang, r.text) for r in docs.select("lang", "text").collect()], least, top)
    assert want and as_counter(got, *COLUMNS) == want


def test_phrases_in_many_blocks(docs, monkeypatch):
    """A full sketch and small blocks: more candidates and tries, the same result."""
    monkeypatch.setattr(phrases, "BLOCK", 700)
    monkeypatch.setattr(phrases, "FAN", 2)
    got = phrases.collocations(*phrases.count_phrases(docs, 3), 100)
    assert as_counter(got, *COLUMNS) == brute_phrases([(r.lang, r.text) for r in docs.select("lang", "text").collect()], 3, 100)


def test_phrases_empty(no_docs):
    totals, counted = phrases.count_phrases(no_docs)
    assert not phrases.collocations(totals, counted).collect()
    with pytest.raises(ValueError):
        phrases.count_phrases(no_docs, 256)


def test_scores_beyond_64_bits(spark):
    big = 6_000_000_000_000
    counted = spark.createDataFrame([("en", "a", 1, big + 7), ("en", "b", 1, big + 1), ("en", "a b", 2, big)], "lang string, phrase string, words int, f long")
    (r,) = phrases.collocations(spark.createDataFrame([("en", 9)], "lang string, n long"), counted).collect()
    assert r.score == 2000000 * big // (2 * big + 8)


@pytest.mark.parametrize(("n", "width", "vocabulary"), [(1, 2, 1), (500, 2, 30), (3000, 4, 40), (4000, 3, 3000)])
def test_double_array(n, width, vocabulary):
    """Exactly the phrases of the trie are counted, wherever they stand."""
    r = np.random.default_rng(n)
    known = r.integers(0, 1 << 63, vocabulary, dtype=np.uint64)
    rows = np.unique(known[r.integers(0, vocabulary, (n, width)) ** 2 % vocabulary], axis=0)
    trie = phrases.DoubleArray(rows)
    text = np.concatenate((known[r.integers(0, vocabulary, 5000)], rows[:50].ravel(), np.array([5], np.uint64)))
    p = phrases.Positions(b"", None, None, text, r.random(len(text)) < 0.9, None)
    total = np.zeros(len(rows), np.int64)
    trie.count(p, total)
    want = Counter(tuple(text[i : i + width]) for i in np.flatnonzero(p.runs(width)))
    assert total.tolist() == [want[tuple(x)] for x in rows]
    assert len(trie.base) < 8 * 2 * width * len(rows) + 12 * trie.digits


# ---- 12 -----------------------------------------------------------------------------------------------------------

LICENSED = [
    "Released under the MIT License. under the mit license",
    "CC-BY-NC CC BY NC\ncc by, nc",
    "under the mitK license, under the mİt license; Apache License, Version 2.0",
    "x " * 5 + next(t.text for t in licenses.TEMPLATES if t.label == "isc").upper(),
    "some words " + next(t.text for t in licenses.TEMPLATES if t.label == "isc").replace("for any purpose", "by all of us, for any good purpose").replace("hereby", ""),
    " ".join(next(t.text for t in licenses.TEMPLATES if t.label == "isc").split()[:15]),
    "é" * 9 + " under the gnu general public license, version 3",
    "the software of the software " * 200,
]


def brute_base(text):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    found = [(i, t.label) for t in licenses.TEMPLATES if t.base for i in range(len(w)) if [x.encode() for x in t.words] == w[i : i + len(t.words)]]
    at = [i for i, _ in found]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_licenses(spark, docs, rows):
    more = spark.createDataFrame([(None if k == 2 else 100 + k // 2, t) for k, t in enumerate(LICENSED)], "doc_id long, text string")
    every = docs.select("doc_id", "text", "key", "node").unionByName(more, allowMissingColumns=True)
    got = licenses.scan(every)
    all_rows = rows + [(None if k == 2 else 100 + k // 2, t) for k, t in enumerate(LICENSED)]
    assert as_counter(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == Counter((i, *brute_base(t)) for i, t in all_rows)
    out = got.collect()
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in out)
    own = [licenses.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).first() for t in LICENSED[3:]]
    assert [r.labels for r in own] == ["isc", "isc", "", "gpl,gpl-3", ""]
    assert own[0].score == 1 and 0.6 <= own[1].score < 1 and 0.2 < own[2].score < 0.6


def test_licenses_empty(no_docs):
    assert not licenses.scan(no_docs).collect()


def test_licenses_run_no_python(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_templates_that_cannot_match(docs):
    with pytest.raises(ValueError):
        licenses.scan(docs, [licenses.Template("short", "two words")])


# ---- 13 -----------------------------------------------------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return Counter(), None
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(kept[0][2]) // parts
    cut = lambda v: [v[p * size : p * size + size] for p in range(parts)]
    books = [[cut(r[2])[p] for r in order[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda x, book: min(range(len(book)), key=lambda e: (gap(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for _, _, v in kept:
                x = cut(v)[p]
                of[best(x, books[p])].append(x)
            for e, xs in of.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, per_label = [], Counter()
    for i, lab, v in kept:
        code = [best(x, books[p]) for p, x in enumerate(cut(v))]
        error = sum(gap(x, books[p][c]) for p, (x, c) in enumerate(zip(cut(v), code)))
        per_label[lab] += error
        out.append((i, "".join(f"{c:02x}" for c in code), error, lab))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((i, c, e, per_label[lab], digest) for i, c, e, lab in out), digest


def vectors(n, seed=1):
    r = np.random.default_rng(seed)
    made = [(int(i), int(i) % 3 if i % 7 else None, r.choice([-0.5, -0.25, 0.001, 0.3], 16).tolist() if i % 2 else r.normal(0, 0.2, 16).tolist()) for i in r.permutation(n)]
    odd = [(3, 1, None), (500, None, [None] + [0.1] * 15), (501, 0, [math.nan] + [0.1] * 15), (502, 0, [math.inf] + [0.1] * 15), (None, 2, [0.5] * 16)]
    return made + odd + made[:4] + [(made[0][0], 9, [0.25] * 16)]


VEC_SCHEMA = "vec_id long, label int, embedding array<double>, key string, near int"


@pytest.mark.parametrize("n", [0, 5, 300])
def test_vector_codes(spark, n):
    rows = vectors(n) if n else [(1, 1, None)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], VEC_SCHEMA).repartition(3)
    got = vector_codes.with_label_error(vector_codes.compress(df))
    want, _ = brute_codes(rows)
    assert as_counter(got, "vec_id", "code", "error", "label_error", "codebooks_sha256") == want


def test_bounds_save_work_and_lose_nothing():
    r = np.random.default_rng(5)
    entries = r.integers(-4000, 4000, (2, 16, 8))
    books = vector_codes.Codebooks(entries, entries[:, : vector_codes.PIVOTS].copy())
    x = entries[:, r.integers(0, 16, 400)].transpose(1, 0, 2) + r.integers(-300, 300, (400, 2, 8))
    x[:50] = x[50:100]
    code, best, tried = vector_codes.nearest(x, vector_codes.pivot_distances(x, books.pivots), books)
    every = ((x[:, :, None] - entries[None]) ** 2).sum(3)
    assert (code == every.argmin(2)).all() and (best == every.min(2)).all()
    assert tried < every.size / 2


def test_vectors_that_do_not_fit(spark):
    for rows in ([(1, 1, [0.5] * 8), (2, 1, [0.5] * 16)], [(1, 1, [0.5] * 9)], [(1, 1, [1e30] * 8)]):
        with pytest.raises(Exception, match="components|beyond"):
            vector_codes.compress(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
