"""Queries beside their SQL on tables with odd rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import pytest

from tools.check_oracle import TABLES, compare, duck
from voxlode.operators import clustering as C
from voxlode.operators import containment as T
from voxlode.operators import graph as G
from voxlode.operators import similarity as S
from voxlode.plans import load_all
from voxlode.session import checkpoint_root

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")


def tables(folder: Path, **changed: str) -> str:
    """A folder with the given tables, some of them replaced by a query over ``given``, the table itself."""
    con = duckdb.connect()
    for t in TABLES:
        if t in changed:
            con.execute(f"CREATE OR REPLACE VIEW given AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
            con.execute(f"COPY ({changed[t]}) TO '{folder}/{t}.parquet'")
        else:
            (folder / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    return str(folder)


def check(spark, name: str, folder: str) -> None:
    status, note, _ = compare(spark, duck(folder), load_all()[name], folder)
    assert status == "ok", note


def test_unify_sources_of_empty_fields(spark, tmp_path):
    odd = "CASE {} % 11 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN ' ' WHEN 4 THEN chr(160) WHEN 5 THEN chr(11) WHEN 6 THEN chr(10) || chr(9) ELSE text END AS text"
    fields = "CASE doc_id % 13 WHEN 1 THEN NULL ELSE lang END AS lang, CASE doc_id % 17 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN ' ' ELSE source END AS source"
    check(spark, "unify_sources", tables(
        tmp_path, documents=f"SELECT doc_id, {odd.format('doc_id')}, {fields}, n_chars FROM given", conversations=f"SELECT conv_id, turn, role, {odd.format('(conv_id * 10 + turn)')} FROM given"
    ))


@pytest.mark.parametrize("name", ["similar_pairs", "similar_pairs_levels"])
def test_similar_pairs_lists_all_pairs_of_copies(spark, tmp_path, name):
    rows = "SELECT * FROM given UNION ALL SELECT vec_id + k * 1000, embedding, label FROM given, range(1, 4) t(k) WHERE vec_id % 5 = 0"
    check(spark, name, tables(tmp_path, embeddings=rows))


def test_similar_pairs_of_more_copies_than_a_row_holds(spark):
    n = 2 * S.COPIES + 40
    rows = spark.createDataFrame([(f"{i:04d}", [1.0, 0.0] if i else [1.0, 0.1]) for i in range(n)], "id string, v array<double>")
    got = S.similar_pairs(rows, "id", "v", 0.9, every=True)
    assert got.count() == got.select("i", "j").distinct().count() == n * (n - 1) // 2
    assert got.filter("i >= j").isEmpty() and got.filter("sim < 0.9").isEmpty()


@pytest.mark.parametrize("whole", [0, None])
def test_components_by_rounds_and_in_one_task(spark, whole):
    r = np.random.default_rng(3)
    i, j = r.integers(0, 900, 700), r.integers(0, 900, 700)
    edges = spark.createDataFrame([(f"n{a:04d}", f"n{b:04d}") for a, b in zip([*i.tolist(), *range(1000, 1300)], [*j.tolist(), *range(1001, 1301)])], "i string, j string")
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for e in edges.collect():
        a, b = find(e.i), find(e.j)
        if e.i != e.j:
            up.setdefault(e.i, e.i), up.setdefault(e.j, e.j)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in G.connected_components(edges, whole=whole).collect()}
    assert got == {x: find(x) for x in up}


def test_linkage_of_a_large_component_in_one_task():
    """Ten thousand vectors of one component need no matrix of all distances and no rounds over the cluster."""
    assert C.LINKAGE_ROWS >= 10_000
    r = np.random.default_rng(5)
    x = np.repeat(r.normal(size=(500, 32)), 20, axis=0) + 0.2 * r.normal(size=(10_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = C._linkage(x, np.ones(len(x)), 0.42)
    assert (label == np.repeat(np.arange(0, 10_000, 20), 20)).mean() > 0.9 and (label <= np.arange(10_000)).all()
    small = C._linkage(x[:400], np.ones(400), 0.42)
    mean = np.stack([x[:400][small == k].mean(axis=0) for k in np.unique(small)])
    near = mean @ mean.T
    assert (near[~np.eye(len(near), dtype=bool)] <= 1 - 0.42).all()


def test_need_view_takes_channels_in_turn(spark):
    """References come from all reviews of a need, so its channels stand side by side however new their reviews are."""
    rows = load_all()["need_view"].run(spark, SF).collect()
    channel = lambda x: int(x[4:]) % 3
    for r in rows:
        refs, named = r.references.split(","), r.sources.split(",")
        total = sum(int("".join(c for c in s if c.isdigit())) for s in named)
        assert len(refs) == len(set(refs)) == min(5, total)
        assert len({channel(x) for x in refs[: len(named)]}) == min(len(named), len(refs))


def test_kmeans_over_all_tasks_leaves_no_rounds_behind(spark):
    """Labels and centres of a round are deleted when the next one has ended."""
    x = np.random.default_rng(8).normal(size=(200, 4))
    df = spark.createDataFrame([(0, i, v.tolist()) for i, v in enumerate(x)], "g long, id long, vec array<double>")
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(root.glob("kmeans-*"))
    assert C.split_oversize(df, "g", "id", "vec", task_rows=20).count() == 200
    assert 1 <= len(set(root.glob("kmeans-*")) - before) <= 2


def test_lowest_contained_keeps_one_round(spark):
    """Places whose key nobody looks for drop out, and what a round stored is deleted when the next one has ended."""
    r = np.random.default_rng(4)
    base = ["".join(r.choice(list("abcdefgh"), 60)) for _ in range(120)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(base)], "r long, text string")
    asks = spark.createDataFrame([(i, base[i][20:50] if i % 2 else f"xx{base[i]}yy") for i in range(120)], "id long, text string")
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(root.glob("lowest-*"))
    got = {x.id: x.r for x in T.lowest_contained(asks, rows).collect()}
    assert got == {i: i for i in range(120)}
    assert len(set(root.glob("lowest-*")) - before) == 1
    keys = spark.createDataFrame([(0, 0, f) for f in range(5)], "id long, kind int, f long")
    places = spark.createDataFrame([(i, 0, i) for i in range(1000)], "id long, kind int, f long")
    kept = {x.f for x in T.passing(places, T.filter_of(keys)).collect()}
    assert kept >= set(range(5)) and len(kept) < 100
