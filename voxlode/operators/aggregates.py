"""Aggregations.  Counts are pre-aggregated by (group, value) before anything is packed per group,
and only lists whose length is part of the result (top n) are ever collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import col


def distribution(df: DataFrame, by: Sequence[str], value: str, order: Column | None = None) -> DataFrame:
    """Long form: one row per (group, value) with ``n`` and, for ties, the first ``order`` seen."""
    first = F.min(order if order is not None else F.col(value)).alias("first_seen")
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), first)


def pack_top(long: DataFrame, by: Sequence[str], key: str, n: str, top: int, tie: Sequence[str]) -> Column | DataFrame:
    """Map of the ``top`` largest entries per group, in descending order; empty groups get ``{}``."""
    w = W.partitionBy(*by).orderBy(F.col(key).isNull(), F.desc(n), *tie, key)
    kept = long.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top)
    entry = F.when(F.col(key).isNotNull(), F.struct("_r", F.col(key).alias("k"), F.col(n).alias("v")))
    packed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))
    return kept.groupBy(*by).agg(F.map_from_entries(packed).alias("dist"))


def distribution_map(
    df: DataFrame, by: Sequence[str], value: str, top: int, order: Column | None = None
) -> DataFrame:
    """``dist``: value -> count map of the ``top`` most common values per group, ties by first seen."""
    return pack_top(distribution(df, by, value, order), by, value, "n", top, ["first_seen"])


def merge_maps(df: DataFrame, by: Sequence[str], map_col: str, top: int = 20) -> DataFrame:
    """Sum value -> count maps over the members of each group; the largest ``top`` keys stay."""
    rows = df.select(*by, F.explode_outer(map_col).alias("k", "v"))
    summed = rows.groupBy(*by, "k").agg(F.sum("v").alias("n"))
    return pack_top(summed, by, "k", "n", top, [])


def weighted_avg(value: Column | str, weight: Column | str) -> Column:
    """Aggregate: weighted mean, 0 for no weight."""
    return F.coalesce(F.sum(col(value) * col(weight)), F.lit(0.0)) / F.greatest(F.coalesce(F.sum(col(weight)), F.lit(0)), F.lit(1))


def consolidate_attrs(
    members: DataFrame,
    by: Sequence[str],
    order: str,
    attrs: Sequence[str],
    size: str = "size",
    weight: str = "avg_weight_signal",
    kind: str = "demand_type",
    tier: str = "demand_tier",
    score: str = "ai_score",
) -> DataFrame:
    """One row per group of merged items.

    Type by summed size, smallest tier, largest score, ``attrs`` of the largest member (first in
    ``order`` on ties), weighted average, rounded mean score as ``mean_score``.
    """
    kinds = members.groupBy(*by, kind).agg(F.sum(size).alias("_s"), F.min(order).alias("_o"))
    best_kind = kinds.groupBy(*by).agg(
        F.max_by(kind, F.struct(F.col("_s"), -F.col("_o"))).alias(kind)
    )
    big = F.struct(F.col(size), -F.col(order))
    rest = members.groupBy(*by).agg(
        F.count(F.lit(1)).alias("members"),
        F.sum(size).alias(size),
        F.bround(weighted_avg(weight, size), 2).alias(weight),
        F.min(tier).alias(tier),
        F.max(score).alias(score),
        F.bround(F.avg(score)).cast("int").alias("mean_score"),
        *[F.max_by(a, big).alias(a) for a in attrs],
    )
    return rest.join(best_kind, list(by))


def first_items(members: DataFrame, by: Sequence[str], items: str, order: str, n: int = 10) -> DataFrame:
    """``items``: the first ``n`` elements of the members' arrays, concatenated in member order."""
    rows = members.select(*by, F.col(order).alias("_o"), F.posexplode(items).alias("_p", "_x"))
    w = W.partitionBy(*by).orderBy("_o", "_p")
    kept = rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    packed = F.array_sort(F.collect_list(F.struct("_r", "_x")))
    return kept.groupBy(*by).agg(F.transform(packed, lambda e: e["_x"]).alias(items))


def funnel(df: DataFrame, stages: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows surviving each stage, counted in one pass.

    A row survives a stage when it passes that stage and all earlier ones.  Yields one row per
    (group, stage) with ``n`` and the share of the first stage in percent.
    """
    alive, aggs = F.lit(True), []
    for i, cond in enumerate(stages.values()):
        alive = alive & F.coalesce(cond, F.lit(False))
        aggs.append(F.count_if(alive).alias(f"_s{i}"))
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("stage"), F.col(f"_s{i}").alias("n"))
        for i, name in enumerate(stages)
    ])
    return wide.select(*by, "_s0", F.inline(rows)).select(
        *by, "ord", "stage", "n", (F.col("n") / F.greatest("_s0", F.lit(1)) * 100).alias("retention_pct")
    )


def top_reasons(df: DataFrame, reason: Column, by: Sequence[str], n: int = 5) -> DataFrame:
    """The most frequent reasons per group; the part after a colon is ignored."""
    counts = (
        df.withColumn("reason", F.substring_index(reason, ":", 1))
        .groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n"))
    )
    w = W.partitionBy(*by).orderBy(F.desc("n"), "reason")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def group_stats(
    df: DataFrame, by: Sequence[str], rating: str, app: str, source: str, min_count: int = 1
) -> DataFrame:
    """Count, mean rating (missing and 0 ignored), share of ratings up to 2, distinct apps and sources."""
    r = F.when(F.col(rating) > 0, F.col(rating))
    # Pre-aggregated per (group, app, source): the distinct counts then see few rows.
    part = df.groupBy(*by, app, source).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(r).alias("_sum"), F.count(r).alias("_rated"), F.count_if(F.col(rating) <= 2).alias("_low")
    )
    return (
        part.groupBy(*by)
        .agg(
            F.sum("_n").alias("mentions"),
            (F.sum("_sum") / F.sum("_rated")).alias("avg_rating"),
            (F.sum("_low") / F.sum("_n")).alias("low_share"),
            F.countDistinct(app).alias("apps"),
            F.countDistinct(source).alias("sources"),
        )
        .filter(F.col("mentions") >= min_count)
    )


def distinct_values(df: DataFrame, by: Sequence[str], value: str, cap: int | None = None) -> DataFrame:
    """Distinct non-null values per group as rows, the first ``cap`` in order."""
    rows = df.filter(F.col(value).isNotNull()).select(*by, value).distinct()
    if cap is None:
        return rows
    w = W.partitionBy(*by).orderBy(value)
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= cap).drop("_r")


def distinct_union(df: DataFrame, by: Sequence[str], items: Column, cap: int) -> DataFrame:
    """``items``: sorted distinct elements of an array column over all rows of a group, at most ``cap``."""
    rows = distinct_values(df.select(*by, F.explode(items).alias("_x")), by, "_x", cap)
    return rows.groupBy(*by).agg(F.array_sort(F.collect_list("_x")).alias("items"))


def totals_and_share(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Counts per (outer, inner), per outer and overall, each with its share of the grand total in percent."""
    agg = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    total = agg.agg(F.sum("n")).scalar()
    cube = agg.rollup(outer, inner).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    return cube.withColumn("share_pct", F.col("n") / total * 100)


def mode_value(df: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """Most frequent non-null value per group, ties by first seen."""
    c = distribution(df.filter(F.col(value).isNotNull()), by, value, F.col(order))
    w = W.partitionBy(*by).orderBy(F.desc("n"), "first_seen", value)
    return c.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*by, value, "n")


def title_from(intent: Column | str, cap: int = 20, stop: str = r"[，。！？,.!?]") -> Column:
    """Text before the first punctuation, capped with an ellipsis."""
    head = F.regexp_replace(col(intent), f"(?s){stop}.*", "")
    return F.when(F.length(head) > cap, F.concat(F.substring(head, 1, cap), F.lit("..."))).otherwise(head)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of the values of several columns in one pass: (dimension, value, n)."""
    cells = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(cells)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, value: str, n: int) -> DataFrame:
    c = df.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), value).limit(n)


def token_cost(
    replies: DataFrame, prompt: str, completion: str, results: str, prompt_price: float = 1.0, completion_price: float = 2.0
) -> DataFrame:
    """Usage and cost of an enrichment run; prices are per million tokens."""
    p, c = F.coalesce(F.sum(prompt), F.lit(0)), F.coalesce(F.sum(completion), F.lit(0))
    n = F.count(F.lit(1))
    return replies.agg(
        n.alias("rows"),
        p.alias("prompt_tokens"),
        c.alias("completion_tokens"),
        F.bround(p / 1e6 * prompt_price + c / 1e6 * completion_price, 4).alias("cost"),
        F.count_if(F.coalesce(F.col(results), F.lit(0)) == 0).alias("empty_or_failed"),
        F.bround(F.coalesce(F.sum(results), F.lit(0)) / F.greatest(n, F.lit(1)), 2).alias("avg_results"),
    )


def match_rate(df: DataFrame, matched: Column, group: str) -> DataFrame:
    """Matched rows, total, rate, and groups with at least one match."""
    return df.agg(
        F.count_if(matched).alias("matched"),
        F.count(F.lit(1)).alias("total"),
        (F.count_if(matched) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("rate"),
        F.countDistinct(F.when(matched, F.col(group))).alias("groups_touched"),
    )


def coverage_by_product(df: DataFrame, category: str, app: str) -> DataFrame:
    return df.groupBy(category, app).agg(F.count(F.lit(1)).alias("n"))


def format_distribution(counts: Column | str, names: Mapping[str, str] | None = None, joiner: str = ", ") -> Column:
    """``name(n)`` list of a map by descending count, ties by name."""
    label = F.lit
    entries = F.array_sort(
        F.transform(F.map_entries(col(counts)), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k")))
    )

    def show(e: Column) -> Column:
        shown = e["k"]
        for k, v in (names or {}).items():
            shown = F.when(e["k"] == k, label(v)).otherwise(shown)
        return F.concat(shown, F.lit("("), (-e["n"]).cast("string"), F.lit(")"))

    return F.array_join(F.transform(entries, show), joiner)


def matched_group(hits: DataFrame, rule: str, hit_count: str, row_id: str, app: str, top: int = 5, min_rows: int = 2) -> DataFrame:
    """Per rule: matched rows, the ``top`` rows by hits and the apps among them; small groups dropped."""
    totals = hits.groupBy(rule).agg(F.count(F.lit(1)).alias("matched")).filter(F.col("matched") >= min_rows)
    w = W.partitionBy(rule).orderBy(F.desc(hit_count), row_id)
    best = hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top)
    packed = best.groupBy(rule).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(row_id).alias("x")))), lambda e: e["x"]).alias("top_rows"),
        F.array_sort(F.collect_set(app)).alias("apps"),
    )
    return totals.join(packed, rule)
