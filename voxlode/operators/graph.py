"""Graph algorithms on edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r.n, r.h or 0


WHOLE = 1 << 20  # edges up to which one task finds the parts


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges (u, v): roots hang themselves under the lowest root beside them until none has one."""
    rows = pa.Table.from_batches(list(batches))
    ends = pa.concat_arrays([c.combine_chunks() for c in rows.columns])
    nodes = pc.unique(ends)
    nodes = nodes.take(pc.array_sort_indices(nodes))
    i, j = pc.index_in(ends, value_set=nodes).to_numpy().astype(np.int64).reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]
    yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(root))], ["node", "component"])


def connected_components(edges: DataFrame, src: str = "i", dst: str = "j", whole: int | None = None) -> DataFrame:
    """(node, component): the lowest node id of each connected part, for all nodes with an edge.

    Alternates large-star and small-star steps: every node links its neighbours to the smallest of them.
    Each step is an aggregate and a join on the node, so hubs are pre-aggregated and no
    neighbour list is ever held in memory.  Rounds grow with the logarithm of the number of nodes.  Up to ``whole`` edges need no rounds: one
    task finds their parts.
    """
    e = cut(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct()
    )
    before = _state(e)
    if before[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    if before[0] <= (WHOLE if whole is None else whole):
        kind = e.schema["u"].dataType.simpleString()
        return cut(e.repartition(1).mapInArrow(_parts, f"node {kind}, component {kind}"))
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
        e = cut(small)
        after = _state(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


LEADER_BLOCK = 20_000


def _decide(pdf: pd.DataFrame) -> pd.DataFrame:
    """Decide what a block of ranks can decide by itself: (node, leads) of nodes all of whose earlier neighbours are known.

    Rows without ``earlier`` are the block's nodes; the others are edges to undecided or leading nodes.
    """
    nodes = pdf[pdf.earlier.isna()].sort_values("rank").node.tolist()
    edges: dict = {}
    for later, earlier, leads in zip(pdf.node, pdf.earlier, pdf.leads):
        if not pd.isna(earlier):
            edges.setdefault(later, []).append((earlier, bool(leads)))
    state: dict = {}
    for v in nodes:
        seen = [True if leads else state.get(e) for e, leads in edges.get(v, ())]
        if any(x is True for x in seen):
            state[v] = False
        elif all(x is False for x in seen):
            state[v] = True
    return pd.DataFrame({"node": pd.Series(list(state), dtype=object), "leads": pd.Series(list(state.values()), dtype=bool)})


def first_leaders(nodes: DataFrame, edges: DataFrame, block: int = LEADER_BLOCK) -> DataFrame:
    """Greedy leaders in rank order.

    ``nodes``: node, rank (unique).  ``edges``: later, earlier (an edge says the later node would be absorbed by
    the earlier one if that one is a leader).  A node whose earlier neighbours are all absorbed
    leads; a node with a leading earlier neighbour is absorbed.  The outcome equals the loop
    that takes nodes one by one.  Yields (node, leader) with leader = node for leaders; absorbed nodes
    get their earliest leader.

    Nodes are cut into blocks of ``block`` ranks.  In each round every block follows chains of any length inside it, and the first
    block with open nodes closes for good, so rounds never exceed the number of blocks; there is no limit on them.
    """
    kind = nodes.schema["node"].dataType.simpleString()
    # Text keys keep every kind of id exact in pandas.
    ranks = nodes.select(F.col("node").cast("string").alias("node"), F.col("rank").cast("long").alias("rank"), F.floor(F.col("rank") / block).cast("long").alias("block"))
    open_ = cut(ranks)
    live = cut(edges.select(F.col("later").cast("string").alias("node"), F.col("earlier").cast("string").alias("earlier"), F.lit(False).alias("leads")))
    decided = None
    while not open_.isEmpty():
        rows = open_.select("block", "rank", "node", F.lit(None).cast("string").alias("earlier"), F.lit(False).alias("leads")).unionByName(
            live.join(open_, "node").select("block", "rank", "node", "earlier", "leads")
        )
        new = cut(rows.groupBy("block").applyInPandas(_decide, "node string, leads boolean"))
        decided = new if decided is None else decided.unionByName(new)
        open_ = cut(open_.join(new, "node", "left_anti"))
        known = new.select(F.col("node").alias("earlier"), F.col("leads").alias("_leads"))
        live = cut(
            live.join(new.select("node"), "node", "left_anti").join(known, "earlier", "left")
            .filter(F.coalesce("_leads", F.lit(True))).select("node", "earlier", F.coalesce("_leads", "leads").alias("leads"))
        )
    if decided is None:
        return nodes.select("node", F.col("node").alias("leader"))
    leaders = decided.filter("leads").select(F.col("node").cast(kind).alias("node"))
    lead = leaders.select(F.col("node").alias("earlier")).join(nodes.select(F.col("node").alias("earlier"), "rank"), "earlier")
    absorbed = (
        edges.join(leaders.select(F.col("node").alias("later")), "later", "left_anti")
        .join(lead, "earlier")
        .groupBy("later").agg(F.min_by("earlier", "rank").alias("leader"))
        .select(F.col("later").alias("node"), "leader")
    )
    return leaders.select("node", F.col("node").alias("leader")).unionByName(absorbed)
