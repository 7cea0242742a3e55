"""Every operator against a brute-force version on texts with all awkward cases, and on empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxlode.llm import bpe, decontam, divergence, flat, idfile, lm, ngram_join, queries, sharding, suffix_dedup, toxicity, warc
from voxlode.session import checkpoint_root, scratch_path

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def as_counter(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# ---- 1 ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [50, 3000, 1 << 30])
def test_sharding(docs, rows, limit):
    got = sharding.assign(docs, limit).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t in rows)
    shards = defaultdict(list)
    for r in got:
        shards[(r.depth, r.prefix)].append(r)
    for (depth, _), members in shards.items():
        assert {r.shard_bytes for r in members} == {sum(r.n_bytes for r in members)}
        assert {r.shard_rows for r in members} == {len(members)}
        assert all(r.oversize == (r.shard_bytes > limit) for r in members)
        assert depth == 48 or members[0].shard_bytes <= limit
    # No shard lies inside another, and two that could be one are too large together.
    for d, p in shards:
        assert not any((e, p >> (d - e)) in shards for e in range(d))
        if d and (d, p ^ 1) in shards:
            assert shards[(d, p)][0].shard_bytes + shards[(d, p ^ 1)][0].shard_bytes > limit


def test_sharding_hot_key(spark):
    df = spark.createDataFrame([(1, "x" * n) for n in range(1, 60)], "doc_id long, text string")
    got = sharding.assign(df, 200).collect()
    assert len(got) == 59 and max(r.shard_bytes for r in got) <= 200
    with pytest.raises(ValueError):
        sharding.assign(df, 0)


# ---- 2 ------------------------------------------------------------------------------------------------------------


def brute_repeats(rows, width):
    """Counter of (id, length, removed, spans, digest of what is left)."""
    seen, out = set(), Counter()
    first = lambda x: (x[0] is not None, x[0] or 0, (x[1] is not None, x[1] or ""))
    for i, t in sorted(rows, key=first):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[(i, len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone) if not g)))] += 1
    return out


@pytest.mark.parametrize("width", [50, 100])
def test_suffix_dedup(docs, rows, width):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs, width))
    assert as_counter(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows, width)


def test_suffix_dedup_cut_anchors(docs, rows, monkeypatch):
    """Many ranges, so that splitters cut anchors and windows take the second exchange."""
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 600)
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs, 100))
    assert as_counter(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(rows, 100)


def test_merge_of_runs():
    r = np.random.default_rng(1)
    strings = [bytes(r.integers(97, 99, r.integers(1, 12)).astype(np.uint8)) for _ in range(300)]
    runs, want = [], []
    for k in range(5):
        part = sorted(set(strings[60 * k : 60 * k + 60]))
        runs.append(suffix_dedup.pack_run(part, np.full(len(part), k), np.arange(len(part))))
        want += part
    merged = list(suffix_dedup.merge_runs(runs))
    assert [m[0] for m in merged] == sorted(want)
    for (a, _, _, _), (b, shared, _, _) in zip(merged, merged[1:]):
        assert shared == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_shorten_keeps_columns(docs):
    out = suffix_dedup.shorten(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("text is null").count() == docs.filter("text is null").count()


# ---- 3 and 4 ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


def test_bpe(docs, rows, library):
    path = queries.tokenizer_path()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids, skip_special_tokens=False).encode()))] += 1
    assert as_counter(bpe.round_trip(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    ids = bpe.encode(docs, path)
    assert Counter((r.doc_id, len(r.ids)) for r in ids.collect()) == Counter((i, n) for (i, n, _, _) in want.elements())
    assert as_counter(bpe.decode(ids, path), "doc_id", "text") == Counter((i, t or "") for i, t in rows)


def test_bpe_merges_like_the_library(library):
    r = np.random.default_rng(2)
    pairs = bpe.codec(queries.tokenizer_path())
    alphabet = list("abcderstin  \n\t'sl.,!1290éñß数据🙂  \x1c\x85")
    for _ in range(400):
        text = "".join(r.choice(alphabet, r.integers(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert pairs.encode(text) == ids, repr(text)
        assert pairs.decode(ids).decode() == text


def test_bpe_merges_pre_tokens_together(library, monkeypatch):
    r = np.random.default_rng(8)
    pairs = bpe.codec(queries.tokenizer_path())
    letters = list("abcdeinorstéñß数🙂'.,!1")
    tokens = ["".join(r.choice(letters, n)) for n in [*r.integers(1, 30, 500), bpe.LONG - 1, bpe.LONG, 200]]
    tokens += ["a" * n for n in range(1, 80)]
    ids, size = pairs.merge_all(pa.array(["skipped", *tokens], pa.large_string()).slice(1))
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [pairs.merge(t.encode()) for t in tokens]
    # Only long pre-tokens are merged one by one.
    one_by_one, merge = [], pairs.merge
    monkeypatch.setattr(pairs, "merge", lambda t: one_by_one.append(t) or merge(t))
    texts = [" ".join(tokens), None, "", "<|endoftext|>", "see  <|endoftext|>\n 's <|endoftext|><|endoftext|>" + "x" * 90, " ", "a\n", "word" * 40]
    ids, edge = bpe.encode_column(pa.array(texts), pairs)
    assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert one_by_one and all(len(t) >= bpe.LONG for t in one_by_one)


def test_bpe_digests_of_few_ids_at_a_time(docs, rows, monkeypatch):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    path, batch = queries.tokenizer_path(), pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["key", "text"])
    got = []
    for most in (1 << 18, 7):
        monkeypatch.setattr(bpe, "JOINED", most)
        got.append([b.to_pylist() for b in bpe._digests(path, iter([batch]))])
    assert got[0] == got[1]
    assert as_counter(bpe.round_trip(docs, path), *names) == Counter(tuple(r.values()) for b in got[0] for r in b)


def test_id_files(spark, docs, rows, library):
    folder = scratch_path(spark, "ids")
    idfile.write_ids(docs, folder, queries.tokenizer_path())
    got = idfile.read_index(spark, folder).collect()
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    want = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in encoded)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    assert Counter((r.doc_id, tuple(r.ids)) for r in idfile.read_ids(spark, folder).collect()) == Counter((i, tuple(x)) for i, x in encoded)


@pytest.mark.parametrize("most", [0, 5, 400_000])
def test_ids_of_pieces(library, most, monkeypatch):
    r = np.random.default_rng(9)
    known = idfile.PieceIds(queries.tokenizer_path())
    monkeypatch.setattr(known, "MOST", most)
    asked, encode = [], known.encode
    monkeypatch.setattr(known, "encode", lambda texts: asked.append(len(texts)) or encode(texts))
    words = ["".join(r.choice(list("abcdeinorstéñß数🙂'.,!1\n"), n)) for n in r.integers(1, 20, 2000)] + ["x" * 100, "<|endoftext|>", "", "a\x85"]
    for lot in range(4):
        texts = [" ".join(r.choice(words, n)) for n in r.integers(0, 300, 40)] + [None, "", " ", " <|endoftext|> b", "  c  "]
        asked.clear()
        pieces, code, offset, whole = bpe.cut_pieces(pa.array(texts), known.unsafe)
        ids, size, which = known.ids(pieces, whole)
        ids, edge = bpe.expand(ids, size, which[code], offset)
        assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(known.known) <= most and len(known.known_ids) == known.known_size.sum()
        # Few strings for many pieces.
        assert asked[0] <= -(-len(pieces) // known.ROW) and sum(asked) < len(pieces) / 2
        assert lot == 0 or most < 400_000 or sum(asked) < whole + len(pieces) / 8


def test_shard_format():
    r = np.random.default_rng(4)
    for values in ([], [5], [0] * 9, r.integers(0, 300, 1000), r.permutation(70_000)):
        ids = np.array(values, np.uint32)
        raw = idfile.write_shard(ids, np.array([len(ids), 0]))
        back, per_doc = idfile.read_shard(raw)
        assert back.tolist() == ids.tolist() and per_doc.tolist() == [len(ids), 0]
    with pytest.raises(ValueError):
        idfile.read_shard(raw[:-1])


# ---- 5 ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("listed", [1 << 20, 30])
def test_lm_counts(docs, rows, listed, monkeypatch):
    monkeypatch.setattr(lm, "LISTED", listed)
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    got = lm.score_texts(docs, toxicity.fold("doc_id", 10) == 0).collect()
    count = Counter()
    for i, t in rows:
        if fold(i):
            count.update([*SPACE.findall(lowered(t)), None])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        w = [*SPACE.findall(lowered(t)), None]
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(i, fold(i) == 0, len(w), sum(count[x] > 0 for x in w), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_probabilities_add_up():
    p = lm.Parameters.initial(np.arange(lm.CLASSES))
    context = np.full((lm.CLASSES, lm.ORDER), 7)
    assert np.exp(lm.log_probabilities(p, np.arange(lm.CLASSES), context)).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("scale", [0.1, 1.5, 40.0])
def test_lm_probabilities_of_large_and_small_scores(scale, monkeypatch):
    r = np.random.default_rng(6)
    p = lm.Parameters.initial(np.arange(lm.CLASSES))
    for x in (p.context, p.target, p.bias):
        x[:] = r.normal(0, scale / 4, x.shape)
    n = 700
    target, context = r.integers(0, lm.CLASSES, n), r.integers(0, lm.CLASSES + 1, (n, lm.ORDER))
    q = sum(p.context[context[:, j]].astype(float) @ p.mixers[j].astype(float) for j in range(lm.ORDER))
    s = q @ p.target.T.astype(float) + p.bias
    want = s[np.arange(n), target] - s.max(1) - np.log(np.exp(s - s.max(1)[:, None]).sum(1))
    exponentials, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: exponentials.append(x.size) or exp(x, *a, **k))
    assert lm.log_probabilities(p, target, context) == pytest.approx(want, rel=1e-5, abs=1e-4)
    # Unless scores are large there are as many exponentials as classes and places take, not some for each token.
    assert (sum(exponentials) == lm.ORDER * (lm.CLASSES + 1) * lm.CLASSES) == (scale < 40)
    assert len(lm.log_probabilities(p, target[:0], context[:0])) == 0


def test_lm_learns_an_order():
    """After training, a fixed cycle of classes is likelier than by their shares."""
    text = np.tile([3, 8, 1], 4000)
    share = np.bincount(text, minlength=lm.CLASSES).astype(float)
    t = lm.Trainer(lm.Parameters.initial(share), share, 0)
    target, context = lm.sequences(text, np.array([0, len(text)]))
    for _ in range(3):
        t.train(target, context)
    assert lm.log_probabilities(t.p, target, context).mean() > np.log(1 / 3) + 0.5


def test_lm_beats_counts_on_held_out(spark):
    got = queries.QUERIES["op5_lm"](spark, "/root/testdata/sf0.001").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_learns_the_same_from_any_files(spark, monkeypatch):
    """One partition and 40 give the same model, though a step has several lanes."""
    monkeypatch.setattr(lm, "UNIT", 1 << 13)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = [lm.score_texts(docs.repartition(n), toxicity.fold("doc_id", 10) == 0).agg(F.sum("score"), F.sum("base_score")).first() for n in (1, 40)]
    assert got[0][0] == pytest.approx(got[1][0], rel=1e-5) and got[1][0] > got[1][1]


def test_lm_steps_grow_with_the_corpus():
    assert [lm.plan(n * lm.UNIT) for n in (1, 4, 5, 100, 10_000)] == [(1, 1), (2, 2), (3, 2), (10, 10), (100, 100)]


# ---- 6 ------------------------------------------------------------------------------------------------------------


def brute_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = list(zip(w, w[1:], w[2:]))
    often = Counter(grams)
    hit = [False] * len(w)
    for i, g in enumerate(grams):
        if often[g] > 1:
            hit[i : i + 3] = [True] * 3
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), sum(hit), n < 50 or 100 * sum(hit) > 50 * n


def test_divergence_measures(docs, rows, no_docs):
    refs = divergence.learn_references(docs)
    got = divergence.judge(docs, refs)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert as_counter(got, *columns) == Counter((i, *brute_measures(t)) for i, t in rows)
    assert not got.filter("base_failed and kept").count()
    empty = divergence.learn_references(no_docs)
    assert not empty.common and divergence.judge(no_docs, empty).count() == 0
    assert divergence.judge(docs, empty).filter("kept = base_failed").count() == 0


def test_js_distance():
    p, q = np.array([[1.0, 0.0], [1.0, 1.0], [3.0, 1.0]]), np.array([0.0, 2.0])
    m = (np.array([0.75, 0.25]) + [0, 1]) / 2
    left = 0.75 * np.log2(0.75 / m[0]) + 0.25 * np.log2(0.25 / m[1])
    assert divergence.js_distance(p, q) == pytest.approx([1, np.sqrt((0.5 * np.log2(2) + 0.5 * np.log2(0.5 / 0.75) + np.log2(1 / 0.75)) / 2), np.sqrt((left + np.log2(1 / m[1])) / 2)])


def test_divergence_finds_junk_and_keeps_the_rest(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op6_divergence"](spark, sf).join(queries.given(spark, sf, "labels"), "doc_id").filter("not base_failed")
    good, kept, junk, found = got.agg(F.sum("quality"), F.sum(F.col("quality") * F.col("kept").cast("int")), F.sum(1 - F.col("quality")), F.sum((1 - F.col("quality")) * (~F.col("kept")).cast("int"))).first()
    assert kept >= 0.99 * good and found >= 0.7 * junk


# ---- 7 ------------------------------------------------------------------------------------------------------------


def brute_components(rows, percent, width):
    sets = []
    for _, t in rows:
        w = lowered(t).split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    link = {k: {k} for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                link[a].add(b)
                link[b].add(a)
    out = Counter()
    for k, (i, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            for x in link[todo.pop()] - reach:
                reach.add(x)
                todo.append(x)
        ids = [rows[x][0] for x in reach if rows[x][0] is not None]
        out[(i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i)] += 1
    return out


@pytest.mark.parametrize("least", [1024, 2])
def test_ngram_join(docs, rows, least, monkeypatch):
    """With ``least`` 2 nearly all tokens are frequent, so that pairs of tokens are the keys."""
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", least)
    got = ngram_join.components(docs, percent=85, width=4)
    assert as_counter(got, "doc_id", "n_shingles", "component_id") == brute_components(rows, 85, 4)


def test_ngram_join_group_of_near_copies(spark):
    """A chain of edits: ends of the group are linked through others only."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(40):
        text = list(base)
        for j in range(k % 5):
            text[(17 * k + 41 * j) % 200] = f"own{k}x{j}"
        rows.append((100 - k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 90, 96):
        assert as_counter(ngram_join.components(df, percent, 5), "doc_id", "n_shingles", "component_id") == brute_components(rows, percent, 5)


def test_tokens_sum_bytes_once(monkeypatch):
    """Words and their endings share the sums over all bytes, the dearest part of their hashes."""
    calls = []
    plain = lm.range_sums
    monkeypatch.setattr(lm, "range_sums", lambda buf: calls.append(len(buf)) or plain(buf))
    monkeypatch.setattr(flat, "range_sums", lambda buf: calls.append(len(buf)) or plain(buf))
    h, ending, first = lm.tokens([b"One two", b"", b"one"])
    assert len(calls) == 1 and first.tolist() == [0, 2, 2, 3] and h[0] == h[2] != h[1] and ending[0] == ending[2]


def test_gradient_sums():
    random = np.random.default_rng(2)
    index, rows = random.integers(0, 40, 300), random.normal(size=(300, 5)).astype(np.float32)
    want = np.zeros((50, 5))
    np.add.at(want, index, rows)
    assert np.allclose(lm._grouped(index, rows, 50), want, atol=1e-5)


def test_signatures_rule_out_no_link():
    random = np.random.default_rng(3)
    for n in (1, 2, 40, 63, 64, 65, 700, 3000):
        a = random.integers(0, 1 << 63, n).astype(np.uint64)
        for other in (0, 1, n // 10, n // 2, n):
            b = np.concatenate((a[other:], random.integers(0, 1 << 63, other + n // 8).astype(np.uint64)))
            least = ngram_join.least_difference(ngram_join.signature(a), ngram_join.signature(b))
            assert least == ngram_join.least_difference(ngram_join.signature(b), ngram_join.signature(a))
            assert least <= 2 * other + n // 8 and (least - n // 8) % 2 == 0
            if other == n > 60:
                assert least > n // 4


def test_ngram_join_writes_sets_of_likely_pairs_only(spark):
    """Texts with one shingle in common have a key in common, but their sets are not written."""
    say = lambda k: " ".join([*(f"w{k}x{i}" for i in range(60)), "a", "passage", "they", "share"])
    rows = [(k, say(k)) for k in range(50)] + [(50, say(49) + " twice")]
    written = lambda: set(Path(checkpoint_root(spark).removeprefix("file://")).glob("ngram-sets-*"))
    before = written()
    got = ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert as_counter(got, "doc_id", "n_shingles", "component_id") == brute_components(rows, 85, 4)
    assert sum(spark.read.parquet(str(f)).count() for f in written() - before) == 2


def test_keep_one(docs):
    out = ngram_join.keep_one(docs)
    assert out.columns == docs.columns
    assert 9 not in {r.doc_id for r in out.collect()} and docs.filter("doc_id = 9").count() == 1


def test_keep_one_judges_rows(spark):
    """A clean text stays though its id has a near copy elsewhere; repeated rows and copies with null ids leave one."""
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, say(0)), (5, say(0)), (5, say(1)), (9, say(2)), (9, say(2)), (None, say(0)), (None, say(3)), (None, say(3)), (7, None), (7, None), (8, " "), (11, say(4))]
    got = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(tuple(r) for r in got.collect()) == Counter([(1, say(0)), (5, say(1)), (9, say(2)), (None, say(3)), (7, None), (7, None), (8, " "), (11, say(4))])


# ---- 8 ------------------------------------------------------------------------------------------------------------


def test_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    """A labelled id repeated beyond the bound, with equal and with different texts."""
    monkeypatch.setattr(toxicity, "SAMPLE", 20)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 400)
    docs = spark.range(3000).selectExpr("if(id < 1000, 1, id) AS doc_id", "if(id < 500, 'same text', concat('text ', id)) AS text")
    labels = spark.range(1, 2000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    sample, _ = toxicity.labelled_sample(docs, labels, F.lit(True), "doc_id", "text", "toxic")
    for r in sample.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect():
        assert 0 < r.n <= 20 and r["size"] <= 400


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.given(spark, sf, "documents"), queries.given(spark, sf, "labels")
    few = docs.filter("doc_id < 4000")
    model = toxicity.learn(few, labels, toxicity.fold("doc_id", 5) != 0)
    got = toxicity.score(few, model).join(labels, "doc_id").filter(toxicity.fold("doc_id", 5) == 0)
    right, n = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")), F.count("*")).first()
    assert n > 100 and right >= 0.93


def test_toxicity_edges(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(1, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, toxicity.fold("doc_id", 5) != 0)
    got = toxicity.score(docs, model)
    assert got.count() == len(rows) and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert {r.doc_id for r in got.filter("predicted = 1").collect()} == {24}
    assert toxicity.score(no_docs, toxicity.learn(no_docs, labels, F.lit(True))).count() == 0
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1


def test_label_model_counts_a_clique_once():
    """Five copies of a weak voter do not outvote two independent strong ones."""
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.3
    strong = [np.where(y, r.random(4000) < 0.8, r.random(4000) < 0.02) for _ in range(2)]
    weak = np.where(y, r.random(4000) < 0.4, r.random(4000) < 0.2)
    post = toxicity.label_model(np.column_stack([*strong, *[weak] * 5]).astype(float), (strong[0] | strong[1]).astype(float), np.ones(4000))
    assert ((post > 0.5) == y).mean() > 0.93


# ---- 9 ------------------------------------------------------------------------------------------------------------


def test_warc(spark):
    big = "<p>" + "long text, " * 30_000
    pages = [(5, "http://a/5", "x" * 200), (2, "http://a/2", "x" * 200), (9, None, "x" * 200), (1, "u\r\nv", "short"), (3, "http://a/3", "short"), (4, "", None), (6, "é", ""), (7, "http://a/7", big), (8, "http://a/8", big), (None, "n", "y" * 150), (2, "http://a/2", "x" * 200)]
    df = spark.createDataFrame([(*p, "extra", 1) for p in pages], "page_id long, url string, html string, page string, digest int").repartition(3)
    folder = scratch_path(spark, "warc")
    warc.write_archives(df, folder)
    got = warc.read_archives(spark, folder).collect()
    first = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = Counter()
    for i, _, h in pages:
        raw = (h or "").encode()
        again = i is not None and len(raw) >= 100 and first[h] < i
        want[(i, len(raw), sha(raw), "revisit" if again else "response", first[h] if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.payload is None if r.record_type == "revisit" else sha(bytes(r.payload)) == r.payload_digest for r in got)
    empty = scratch_path(spark, "warc")
    warc.write_archives(df.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_warc_reader_checks():
    one = warc.record(1, "http://a", b"payload" * 50_000, sha(b"payload" * 50_000))
    two = warc.record(2, None, b"", sha(b""))
    for size in (1, 7, 100, 1 << 16):
        data = one + two
        heads = [h["warc-record-id"] for h, _ in warc.read_records(data[i : i + size] for i in range(0, len(data), size))]
        assert heads == ["<urn:page:1>", "<urn:page:2>"]
    import gzip

    plain = gzip.decompress(two)
    for wrong in (plain.replace(b"Content-Length: 0\r\n\r\n", b"Content-Length: 1\r\n\r\n"), plain[:-3], b"no record at all"):
        with pytest.raises(ValueError):
            list(warc.read_records([gzip.compress(wrong)]))
    with pytest.raises(ValueError):
        list(warc.read_records([one[:-10]]))


# ---- 10 -----------------------------------------------------------------------------------------------------------

ITEM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_leaks(rows, items, depth):
    windows = defaultdict(set)
    for i, t in items:
        w = ITEM_WORD.findall(lowered(t))
        n = min(depth, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[j : j + n])].add("" if i is None else str(i))
    out = Counter()
    for i, t in rows:
        w = ITEM_WORD.findall(lowered(t))
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if k := windows.get(tuple(w[j : j + n])):
                    found |= k
                    hit[j : j + n] = [True] * n
        out[(i, len(w), sum(hit), len(found), sha(",".join(sorted(found)).encode()), any(hit))] += 1
    return out


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_decontamination(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", block)
    by_id = dict(rows)
    cut = lambda i, a, b: " ".join((by_id[i] or "").split()[a:b])
    items = [(1, cut(8, 10, 40)), (2, cut(8, 20, 35)), (3, "one"), (4, None), (5, ""), (6, "- !"), (7, cut(19, 100, 130)), (8, "The River, stone LAMP"), (None, cut(11, 5, 17)), (1, cut(12, 0, 11))]
    bench = spark.createDataFrame([(*x, "q") for x in items], "item_id long, text string, matches string")
    found = decontam.find_leaks(docs, bench)
    assert as_counter(decontam.digest(found), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute_leaks(rows, items, 10)
    clean = decontam.remove_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in brute_leaks(rows, items, 10).items() if not k[-1])
    none = decontam.digest(decontam.find_leaks(docs, bench.limit(0)))
    assert none.filter("contaminated").count() == 0 and none.count() == len(rows)


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "zero one two three four five six seven")], "doc_id long, text string")
    bench = spark.createDataFrame([(4, "x one two three four five y"), (5, "six seven")], "item_id long, text string")
    got = decontam.find_leaks(docs, bench, depth=3).first().matches
    assert [tuple(m) for m in got] == [(4, 1, 1, 5), (5, 0, 6, 2)]


# ---- all ----------------------------------------------------------------------------------------------------------


def test_empty_tables(spark, no_docs):
    path = queries.tokenizer_path()
    assert sharding.assign(no_docs, 10).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert bpe.round_trip(no_docs, path).count() == 0
    folder = scratch_path(spark, "ids")
    idfile.write_ids(no_docs, folder, path)
    assert idfile.read_index(spark, folder).count() == 0
    assert lm.score_texts(no_docs, F.lit(False)).count() == 0
    assert ngram_join.components(no_docs).count() == 0
