"""Operators against plain brute-force versions on small data."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlode.operators import aggregates as A
from voxlode.operators import clustering as C
from voxlode.operators import joins as J
from voxlode.operators import ranking as R
from voxlode.operators import similarity as S
from voxlode.operators.graph import connected_components, first_leaders
from voxlode.plans import queries_clustering


def vectors(seed, n, dims=8, groups=10, spread=0.35):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dims))
    x = base[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * spread
    return x, x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")


@pytest.fixture
def small_blocks(monkeypatch):
    """Many cells and blocks even for few rows."""
    monkeypatch.setattr(S, "BLOCK", 16)


# ---------------------------------------------------------------- joins


def test_match_text_rows_equals_nested_loop(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "aa", "b"]
    rows = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    rows += [rows[3], "ab", "", rows[7] + " tail"]
    samples = [rows[5], rows[9][4:60], "x " + rows[2] + " y", rows[11][:55] + " other ending here", "zz", "  ", "b", rows[3], "alpha  beta", ""]

    def bare(s):
        return re.sub(r"\s+", "", s)

    def want(s):
        for i, r in enumerate(rows):
            if r and r == s:
                return i, "exact"
        a = bare(s)
        if not a:
            return None
        for i, r in enumerate(rows):
            b = bare(r)
            if b and (a in b or b in a or (len(a) > 20 and len(b) > 20 and a[:50] == b[:50])):
                return i, "similar"
        return None

    sd = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "sid int, t string")
    rd = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "rid int, t string")
    got = {r.sid: (r.rid, r.how) for r in J.match_text_rows(sd, rd, "t", "sid", "rid").collect()}
    assert got == {i: want(s) for i, s in enumerate(samples) if want(s)}


def test_containing_rows_with_a_full_filter(spark, monkeypatch):
    """A filter that lets everything through costs candidates, not results."""
    from voxlode.operators import containment

    monkeypatch.setattr(containment, "FILTER_BITS", 6)
    hay = spark.createDataFrame([(1, "abcdef"), (2, "xyz"), (3, "a")], "h int, t string")
    needles = spark.createDataFrame([(1, "bcd"), (2, "z"), (3, "a"), (4, "abcdefg")], "n int, u string")
    got = sorted((r.n, r.h) for r in J.containing_rows(needles, hay, "n", "h", "u", "t").collect())
    assert got == [(1, 1), (2, 2), (3, 1), (3, 3)]


def test_match_text_rows_in_rounds(spark, monkeypatch):
    """A passage in a third of the rows and samples of it: lists of several rounds, the lowest row is found."""
    from voxlode.operators import containment

    monkeypatch.setattr(containment, "GROWTH", 2)
    passage = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"row {i} " + (passage[: 60 + i % 7] if i % 3 else f"other text {i}") + f" tail {i}") for i in range(90)]
    samples = [(i, passage[i : 30 + i]) for i in range(25)] + [(100, "x" + rows[40][1] + "y"), (101, "no such text anywhere at all"), (102, "tail 89")]
    bare = lambda s: re.sub(r"\s+", "", s)
    want = {}
    for i, s in samples:
        found = [k for k, r in rows if bare(s) in bare(r) or bare(r) in bare(s)]
        if found:
            want[i] = (min(found), "similar")
    sd, rd = spark.createDataFrame(samples, "sid int, t string"), spark.createDataFrame(rows, "rid int, t string")
    assert {r.sid: (r.rid, r.how) for r in J.match_text_rows(sd, rd, "t", "sid", "rid").collect()} == want


def test_tiered_lookup_order(spark):
    dim = spark.createDataFrame([(0, "AI answer", "a"), (1, "AIanswer", "b"), (2, "answer quality", "c"), (3, "abc", "d")], "o int, k string, s string")
    rows = spark.createDataFrame([("AI answer",), ("AIanswer",), ("A Ianswer",), ("poor answer quality today",), ("quality",), ("abcd",), ("none",)], "t string")
    got = {r.t: (r.tier, r.s) for r in J.tiered_lookup(rows, dim, "t", "k", "o", ["s"]).collect()}
    assert got == {"AI answer": (1, "a"), "AIanswer": (1, "b"), "A Ianswer": (2, "a"), "poor answer quality today": (3, "c"), "quality": (3, "c"), "abcd": (None, None), "none": (None, None)}


def test_resume_twice_equals_once(spark):
    todo = spark.range(10)
    done = spark.range(4)
    left = J.resume_anti_join(todo, done, "id")
    assert left.count() == 6
    assert J.resume_anti_join(todo, done.unionByName(left), "id").count() == 0


# ---------------------------------------------------------------- aggregates and ranking


def test_distribution_map_ties_and_empty(spark):
    df = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("g", "a", 3), ("g", "c", 4), ("g", "b", 5), ("h", None, 6)], "g string, x string, o int")
    out = A.distribution_map(df, ["g"], "x", 2, F.col("o")).select("g", F.map_entries("dist").alias("e"))
    assert {r.g: [tuple(x) for x in r.e] for r in out.collect()} == {"g": [("b", 2), ("a", 2)], "h": []}


def test_weighted_avg_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0)], "v double, w int")
    assert df.agg(A.weighted_avg("v", "w").alias("x")).first().x == 0.0
    assert df.filter("w > 5").agg(A.weighted_avg("v", "w").alias("x")).first().x == 0.0


@pytest.mark.parametrize("parts", [1, 8])
def test_number_rows_over_a_hot_group(spark, parts):
    rows = [("hot" if i % 3 else f"g{i % 7}", (i * 37) % 11, i) for i in range(300)] + [(None, 1, 1000), (None, 0, 1001)]
    df = spark.createDataFrame(rows, "g string, s int, id int").repartition(parts)
    got = {(r.g, r.id): r["rank"] for r in R.number_rows(df, ["g"], [F.desc("s"), F.col("id")]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for k, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[(g, r[2])] = k
    assert got == want


def greedy_near(rows, k):
    """The sequential loop over rows (id, text, score)."""
    taken, out = [], []
    for i, t, s in sorted(rows, key=lambda r: (-r[2], r[0])):
        key = t.strip()[:50]
        if not key or s <= 0:
            continue
        if any(sum(c in o for c in key) > len(key) * 0.6 for o in taken):
            continue
        taken.append(key)
        out.append(i)
        if len(out) >= k:
            break
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_dedupe_near_equals_the_loop(spark, parts):
    rng = random.Random(9)
    rows = []
    for g in ("a", "b", "c"):
        for i in range(40):
            letters = rng.sample("abcdefghijklmnopqrstuvwxyz0123456789", 5)
            rows.append((g, i, "".join(rng.choice(letters) for _ in range(20)), float(rng.randint(-1, 9))))
    rows.append(("d", 1, "   ", 5.0))
    df = spark.createDataFrame(rows, "g string, id int, t string, s double").repartition(parts)
    got: dict = {}
    for r in R.dedupe_near(df, "g", "t", "s", "id").orderBy("g", "rank").collect():
        got.setdefault(r.g, []).append(r.id)
    assert got == {g: greedy_near([r[1:] for r in rows if r[0] == g], 5) for g in ("a", "b", "c")}


def spread_loop(rows, start, days, k):
    """Sequential version of the spread sample over (id, app, day offset, arrival)."""
    seg = days // k
    ok = [r for r in sorted(rows, key=lambda r: r[3]) if 0 <= r[2] <= days]
    used, picked = set(), []
    for s in range(k):
        inside = [r for r in ok if s * seg <= r[2] < (s + 1) * seg]
        if not inside:
            continue
        fresh = [r for r in inside if r[1] not in used]
        row = fresh[0] if fresh else inside[0]
        if fresh:
            used.add(row[1])
        picked.append(row[0])
    if len(picked) < k:
        rest = sorted((r for r in ok if r[0] not in picked), key=lambda r: (r[2], r[3], r[0]))
        step = max(1, len(rest) // (k - len(picked)))
        for i in range(0, len(rest), step):
            if len(picked) >= k:
                break
            if rest[i][1] not in used or len(picked) >= k - 1:
                picked.append(rest[i][0])
                used.add(rest[i][1])
    return sorted(picked)


@pytest.mark.parametrize("parts", [1, 8])
def test_time_stratified_sample_equals_the_loop(spark, parts):
    rng = random.Random(3)
    start = datetime(2025, 1, 1, tzinfo=timezone.utc)
    rows, want = [], {}
    for t, (n, lo, hi) in {"full": (80, 0, 365), "early": (40, 0, 100), "late": (30, 300, 400), "few": (3, 10, 20), "one": (12, 50, 55)}.items():
        mine = [(f"{t}{i}", f"app{rng.randint(0, 3)}", rng.randint(lo, hi), i) for i in range(n)]
        want[t] = spread_loop(mine, start, 365, 5)
        rows += [(t, i, a, start + timedelta(days=d), o) for i, a, d, o in mine]
    df = spark.createDataFrame(rows, "topic string, id string, app string, ts timestamp, o int").repartition(parts)
    out = R.time_stratified_sample(df, "topic", "id", "app", "ts", "o", F.lit("2025-01-01T00:00:00Z").cast("timestamp"), 365)
    got: dict = {}
    for r in out.collect():
        got.setdefault(r.topic, []).append(r.row_id)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_round_robin_prefers_and_alternates(spark):
    rows = [("n", "x", i, False) for i in range(5)] + [("n", "y", 10, True), ("n", "y", 11, True), ("n", "z", 12, True), ("m", "x", 1, False), ("m", "q", 2, False)]
    df = spark.createDataFrame(rows, "need string, ch string, o int, p boolean")
    got = [(r.need, r.o) for r in R.round_robin(df, "need", "ch", F.col("p"), ["o"], ["z", "y"], 5).orderBy("need", "rank").collect()]
    assert got == [("m", 2), ("m", 1), ("n", 12), ("n", 10), ("n", 11)]


def test_proportional_sample_gives_each_source_a_row(spark):
    df = spark.createDataFrame([("big", i) for i in range(97)] + [("small", 100), ("tiny", 200)], "s string, o int")
    got = [(r.s, r.o) for r in R.proportional_sample(df, "s", "o", 10).collect()]
    assert sorted(got) == [("big", i) for i in range(9)] + [("small", 100)]


# ---------------------------------------------------------------- similarity and graphs


@pytest.mark.parametrize("t", [0.6, 0.97])
def test_similar_pairs_equal_brute_force(spark, small_blocks, t):
    x, _ = vectors(1, 150)
    x[50:70] = x[50]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    rep = [50 if 50 <= i < 70 else i for i in range(150)]
    want = {(i, j) for i in range(150) for j in range(i + 1, 150) if sim[i, j] >= t and rep[i] == i and rep[j] == j}
    want |= {(50, j) for j in range(51, 70)}
    got = [(r.i, r.j) for r in S.similar_pairs(frame(spark, x), "id", "v", t).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_similarity_exactly_at_the_threshold(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])], "id long, v array<double>")
    assert {(r.i, r.j) for r in S.similar_pairs(df, "id", "v", 0.8).collect()} == {(2, 3)}
    assert S.similar_pairs(df, "id", "v", 0.8, strict=True).count() == 0


def test_nearest_match_equal_brute_force_and_ties(spark, small_blocks):
    x, u = vectors(2, 120)
    x[90] = x[31]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    new, main = list(range(0, 120, 3)), [i for i in range(120) if i % 3]
    df = frame(spark, x)
    got = {
        r.nid: r.mid
        for r in S.nearest_match(df.filter("id % 3 = 0").select(F.col("id").alias("nid"), "v"), df.filter("id % 3 <> 0").select(F.col("id").alias("mid"), "v"), "nid", "mid", "v", 0.9).collect()
    }
    sim = np.round(u[new] @ u[main].T, 12)
    want = {n: main[int(sim[k].argmax())] for k, n in enumerate(new) if sim[k].max() >= 0.9}
    assert got == want
    tie = spark.createDataFrame([(7, [1.0, 0.0]), (3, [1.0, 0.0])], "mid long, v array<double>")
    one = spark.createDataFrame([(2**60 + 1, [2.0, 0.0])], "nid long, v array<double>")
    assert [(r.nid, r.mid) for r in S.nearest_match(one, tie, "nid", "mid", "v", 0.85).collect()] == [(2**60 + 1, 3)]
    assert S.nearest_match(one, tie.filter("mid > 100"), "nid", "mid", "v", 0.85).count() == 0


def union_find(n, edges):
    p = list(range(n))

    def find(a):
        while p[a] != a:
            p[a] = p[p[a]]
            a = p[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(n)}


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_connected_components(spark, kind):
    n = 60
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(0, 39)],
        "star": [(59, i) for i in range(30)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(45)],
    }[kind]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "i long, j long")).collect()}
    want = union_find(n, edges)
    assert got == {k: v for k, v in want.items() if k in got}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}


def test_first_leaders_equal_the_loop(spark):
    rng = random.Random(4)
    n = 50
    edges = {(b, a) for a, b in ((sorted(rng.sample(range(n), 2))) for _ in range(80))}
    leader: dict[int, int] = {}
    for v in range(n):
        over = [a for b, a in edges if b == v and leader.get(a) == a]
        leader[v] = min(over) if over else v
    nodes = spark.createDataFrame([(v, v) for v in range(n)], "node long, rank long")
    e = spark.createDataFrame(sorted(edges), "later long, earlier long")
    assert {r.node: r.leader for r in first_leaders(nodes, e).collect()} == leader


def test_time_stratified_sample_keeps_topics_of_the_last_day(spark):
    df = spark.createDataFrame([("late", 1, "a", "2025-12-31T12:00:00Z", 1), ("early", 2, "a", "2025-01-02T00:00:00Z", 2)], "topic string, id long, app string, t string, o long")
    df = df.withColumn("ts", F.col("t").cast("timestamp"))
    out = R.time_stratified_sample(df, "topic", "id", "app", "ts", "o", F.lit("2025-01-01T00:00:00Z").cast("timestamp"), 365, k=7)
    assert {(r.topic, r.row_id, r["pass"]) for r in out.collect()} == {("late", 1, 2), ("early", 2, 1)}


def test_first_leaders_on_a_long_chain(spark):
    n = 10_000
    nodes = spark.range(n).select(F.col("id").alias("node"), F.col("id").alias("rank"))
    e = spark.range(1, n).select(F.col("id").alias("later"), (F.col("id") - 1).alias("earlier"))
    for block in (20_000, 3_000):
        got = first_leaders(nodes, e, block)
        assert got.filter("leader <> node - node % 2").count() == 0 and got.count() == n


def test_zero_vectors_and_scopes(spark):
    rows = [(1, "a", [0.0, 0.0]), (2, "a", [0.0, 0.0]), (3, "a", [1.0, 0.0]), (4, "a", [2.0, 0.0]), (5, "b", [1.0, 0.0]), (6, "b", [1.0, 0.1]), (7, None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, c string, v array<double>")
    assert {(r.i, r.j) for r in S.similar_pairs(df, "id", "v", 0.9, by="c").collect()} == {(3, 4), (5, 6)}
    assert {(r.id, r.cluster) for r in C.average_linkage(df, "id", "v", 0.4, by="c").collect()} == {(1, 1), (2, 2), (3, 3), (4, 3), (5, 5), (6, 5), (7, 7)}
    got = S.nearest_match(df.select(F.col("id").alias("n"), "c", "v"), df.filter("id in (1, 3, 5)").select(F.col("id").alias("m"), "c", "v"), "n", "m", "v", 0.9, by="c")
    assert {(r.n, r.m) for r in got.collect()} == {(3, 3), (4, 3), (5, 5), (6, 5)}


def linkage_loop(u, t):
    groups, d = [[i] for i in range(len(u))], 1 - u @ u.T
    while len(groups) > 1:
        h, a, b = min((d[np.ix_(groups[a], groups[b])].mean(), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        if h >= t:
            break
        groups[a] += groups[b]
        del groups[b]
    return {i: min(g) for g in groups for i in g}


@pytest.mark.parametrize("seed,t,cap", [(1, 0.42, None), (2, 0.42, 20)])
def test_average_linkage_equals_the_sequential_run(spark, small_blocks, seed, t, cap):
    x, _ = vectors(seed, 60, dims=6, groups=8, spread=0.5)
    x[10:15] = x[10]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {r.id: r.cluster for r in C.average_linkage(frame(spark, x), "id", "v", t, cap).collect()}
    assert got == linkage_loop(u, t)


def test_linkage_inside_a_task_on_many_inputs():
    for seed in range(12):
        _, u = vectors(seed, 30, dims=5, groups=5, spread=0.6)
        for t in (0.1, 0.3, 0.42, 0.8):
            lab = C._linkage(u.copy(), np.ones(len(u)), t)
            first = {}
            got = {i: first.setdefault(v, i) for i, v in enumerate(lab)}
            assert got == linkage_loop(u, t), (seed, t)


def test_split_oversize_parts(spark):
    x, _ = vectors(3, 200, groups=6, spread=0.1)
    rows = [(0 if i < 5 else 1 if i < 18 else 2, i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "g long, id long, v array<double>")
    out = C.split_oversize(df, "g", "id", "v", task_rows=40).collect()
    assert len(out) == 200 and len({r.id for r in out}) == 200
    assert len({r.part for r in out if r.g == 0}) == 1
    assert 2 <= len({r.part for r in out if r.g == 1}) <= 3
    assert len({r.part for r in out if r.g == 2}) > 10
    same = C.split_oversize(df.repartition(5), "g", "id", "v", task_rows=40).collect()
    assert {(r.id, r.part) for r in out} == {(r.id, r.part) for r in same}


def test_split_oversize_is_the_same_in_one_task_and_over_all(spark, monkeypatch):
    x, _ = vectors(4, 90, groups=6, spread=0.1)
    df = spark.createDataFrame([(i % 9 // 8, i, [float(v) for v in r]) for i, r in enumerate(x)], "g long, id long, v array<double>")
    monkeypatch.setattr(C, "KMEANS_BLOCK", 8)
    one, over_all = ({(r.g, r.id, r.part) for r in C.split_oversize(df, "g", "id", "v", task_rows=n).collect()} for n in (1000, 20))
    assert len(one) == 90 and one == over_all


def test_similar_pairs_by_takes_any_ids(spark, tmp_path):
    """Given ids beyond a million and two, some of which equal others but for millions; two given vectors are equal."""
    x, u = vectors(5, 40, groups=4, spread=0.4)
    x[7], u[7] = x[3], u[3]
    ids = [(i % 4) * 1_000_000 + i // 4 * 10 for i in range(40)]
    given = [(v, [float(c) for c in r], n % 2) for n, (v, r) in enumerate(zip(ids, x))]
    spark.createDataFrame(given, "vec_id long, embedding array<double>, label long").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [(r.i, r.j) for r in queries_clustering.similar_pairs_by(spark, str(tmp_path)).collect()]
    rows = [(v, n) for n, v in enumerate(ids)] + [(v + 4_000_000, n) for n, v in enumerate(ids)]  # all ids are whole tens
    want = {(a, b) for a, i in rows for b, j in rows if a < b and i % 2 == j % 2 and (i == j or u[i] @ u[j] >= 0.3)}
    assert len(got) == len(set(got)) and set(got) == want


def test_greedy_merge_clusters_equals_the_loop(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    clusters = [(f"c{i:02d}", rng.randint(1, 9), i, rng.sample(words, rng.randint(2, 5))) for i in range(40)]
    merged: list[tuple[str, set]] = []
    want = {}
    for key, n, first, terms in sorted(clusters, key=lambda c: (-c[1], c[2], c[0])):
        if n < 3:
            continue
        over = next((k for k, t in merged if len(set(terms) & t) / len(terms) > 0.6), None)
        if over is None:
            merged.append((key, set(terms)))
        want[key] = over or key
    sizes = spark.createDataFrame([(k, n, f) for k, n, f, _ in clusters], "cluster_key string, count long, first long")
    terms = spark.createDataFrame([(k, t) for k, _, _, ts in clusters for t in ts], "cluster_key string, term string")
    assert {r.cluster_key: r.leader for r in C.greedy_merge_clusters(sizes, terms).collect()} == want


def test_split_noise_numbers_by_size(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "y", 3), ("a", "z", 4), ("a", "z", 5), ("a", "z", 6)], "cat string, cluster string, id int")
    clusters, noise = C.split_noise(df, "cat", "id")
    assert {r.cluster: r.cluster_id for r in clusters.collect()} == {"z": "a_c001", "y": "a_c002"}
    assert [r.id for r in noise.collect()] == [1]


def test_merge_pools_and_refresh(spark):
    p = "demand_id string, text string, quality double, pool_rank int"
    best = spark.createDataFrame([("d", "one", 6.0, 1), ("d", "two", 7.0, 2)], p)
    old = spark.createDataFrame([("d", "one", 9.0, 1), ("d", "three", 8.0, 2), ("d", "bad", 2.0, 3)], p)
    got = [(r.text, r.pool) for r in R.merge_evidence_pools([best, old], "demand_id", "text", "quality").orderBy("rank").collect()]
    assert got == [("three", 1), ("two", 0), ("one", 0)]
    ev = spark.createDataFrame([("a", 1), ("b", 2)], "d string, x int")
    fresh = spark.createDataFrame([("a", 10), ("a", 11), ("a", 12), ("b", 20)], "d string, x int")
    assert sorted(r.x for r in R.refresh_evidence(ev, fresh, "d").collect()) == [2, 10, 11, 12]


def test_top_evidence_never_exceeds_k(spark):
    rows = [("d", f"r{i % 9}", i, "forum" if i % 2 else "store", float(i), i % 5 + 1, 5.0) for i in range(40)]
    df = spark.createDataFrame(rows, "demand_id string, source_review_id string, pos int, source string, weight_signal double, rating int, quality_score double")
    out = R.top_evidence(df).collect()
    assert len(out) == 5 and len({r.source_review_id for r in out}) == 5


