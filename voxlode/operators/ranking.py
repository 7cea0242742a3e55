"""Ranking, top-k per group, sampling and first-wins deduplication.

Top-k is written as ``row_number() <= k`` with a literal k, which Spark prunes inside every map task
before the shuffle, so a group of any size costs k rows per task.  Numbering whole groups goes
through range partitions instead of one task per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import col
from ..session import cut


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Exact 1-based row numbers within groups of any size.

    ``order`` must be total (end in an id).  Rows are range-partitioned by group and order, numbered
    inside their partition, and shifted by the counts of the partitions before.  A hot group simply
    spans many partitions.
    """
    keys = [F.col(b) for b in by]
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_m", F.monotonically_increasing_id())
    )
    # Range bounds are sampled, so the numbered rows are stored before they are used twice.
    ranged = cut(ranged).withColumn("_pid", F.shiftright("_m", 33))
    same = lambda a, b: F.equal_null(a, b)
    parts = ranged.groupBy(*by, "_pid").agg(F.min("_m").alias("_start"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*by).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    shift = parts.select(
        *[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)],
        F.col("_pid").alias("_p"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
    )
    cond = F.col("_pid") == F.col("_p")
    for i, b in enumerate(by):
        cond = cond & same(F.col(b), F.col(f"_g{i}"))
    out = ranged.join(shift, cond).withColumn(name, (F.col("_m") + F.col("_shift")).cast("bigint"))
    return out.select(*df.columns, name)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int, name: str = "rank") -> DataFrame:
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def strength(source: Column | str, weight: Column | str, rating: Column | str, forum: str) -> Column:
    """How strong a row is as evidence: votes for forum rows, low rating for the others."""
    return F.when(col(source) == forum, F.coalesce(col(weight), F.lit(0.0))).otherwise(
        6 - F.coalesce(col(rating), F.lit(3))
    ).cast("double")


def top_evidence(rows: DataFrame, k: int = 5, forum: str = "forum") -> DataFrame:
    """The ``k`` strongest reviews per demand.

    ``rows``: demand_id, source_review_id, pos (order of the atom), source, weight_signal, rating,
    quality_score.  Several atoms of one review count once (the first).
    """
    first = top_k(rows, ["demand_id", "source_review_id"], ["pos"], 1, "_a").drop("_a")
    strong = strength("source", "weight_signal", "rating", forum)
    return top_k(first, ["demand_id"], [strong.desc(), F.desc("quality_score"), F.col("source_review_id")], k)


def round_robin(
    rows: DataFrame, need: str, channel: str, preferred: Column, order: Sequence[Column | str], priority: Sequence[str], k: int = 5
) -> DataFrame:
    """``k`` rows per need, taking channels in turn.

    If any row of a need is ``preferred``, only those take part.  Channels come in ``priority``
    order, unknown ones last (by name).
    """
    flagged = rows.withColumn("_p", F.coalesce(preferred, F.lit(False)))
    # The first k of each (need, channel, preferred) are enough to decide everything, and they are few.
    few = top_k(flagged, [need, channel, "_p"], list(order), k, "_turn")
    any_p = F.max("_p").over(W.partitionBy(need))
    turn = few.withColumn("_any", any_p).filter(F.col("_p") | ~F.col("_any")).drop("_p", "_any")
    place = F.lit(len(priority))
    for i, name in reversed(list(enumerate(priority))):
        place = F.when(F.col(channel) == name, i).otherwise(place)
    return top_k(turn, [need], [F.col("_turn"), place, F.col(channel)], k).drop("_turn")


def channel_counts(rows: DataFrame, need: str, preferred: str, channel: str) -> DataFrame:
    """Rows ``n`` of every (need, channel) that :func:`round_robin` chooses from: the preferred ones of a need if it has any, else all."""
    counts = rows.groupBy(need, channel).agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col(preferred)).alias("_p"))
    any_p = F.max("_p").over(W.partitionBy(need)) > 0
    return counts.withColumn("n", F.when(any_p, F.col("_p")).otherwise(F.col("_all"))).filter("n > 0").drop("_all", "_p")


def proportional_sample(rows: DataFrame, source: str, order: str, n: int) -> DataFrame:
    """About ``n`` rows: per source its share, at least one, the first in order; never more than ``n``."""
    counts = rows.groupBy(source).agg(F.count(F.lit(1)).alias("_c"), F.min(order).alias("_first"))
    total = counts.agg(F.sum("_c")).scalar()
    quota = counts.select(
        source, "_first", F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("_c") / total)).alias("_quota")
    )
    # No quota exceeds n, so the first cut is a literal top-k.
    head = top_k(rows, [source], [order], n, "_r")
    taken = head.join(quota, source).filter(F.col("_r") <= F.col("_quota"))
    return taken.orderBy("_first", "_r").limit(n).drop("_r", "_first", "_quota")


def capped_candidates(
    rows: DataFrame, by: str, arrival: Sequence[Column | str], score: str, seen: int = 50, keep: int = 10, show: int = 5
) -> DataFrame:
    """The first ``seen`` rows per group, of those the ``keep`` best, with the shown ones flagged."""
    first = top_k(rows, [by], list(arrival), seen, "arrival")
    best = top_k(first, [by], [F.desc(score), F.col("arrival")], keep, "rank")
    return best.withColumn("shown", F.col("rank") <= show)


def dedupe_first(rows: DataFrame, key: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key in an explicit order."""
    w = W.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 1).drop("_rn")


def dedupe_near(
    rows: DataFrame, by: str, text: str, score: str, row_id: str, k: int = 5, overlap: float = 0.6, key_chars: int = 50
) -> DataFrame:
    """Up to ``k`` rows per group by score, skipping texts too like one already taken.

    A text is too like another when more than ``overlap`` of the characters of its key (first
    characters) occur in the other's key.  Each of the ``k`` steps takes the best remaining row per
    group with an aggregate and drops the rows like it: the same choice as the sequential loop,
    without comparing pairs.  Steps end early when nothing is left.
    """
    from ..functions.text import trim_all

    keyed = rows.withColumn("_key", F.substring(trim_all(text), 1, key_chars)).filter(
        (F.col("_key") != "") & (F.col(score) > 0)
    )
    # Copies of a key always block each other: the best one stands for all.
    left = top_k(keyed, [by, "_key"], [F.desc(score), F.col(row_id)], 1, "_c").drop("_c").select(by, row_id, score, "_key")
    left = cut(left)
    chosen = None
    for step in range(1, k + 1):
        # Aggregated per group with partial aggregation, so a hot group is no problem.
        lead = left.groupBy(by).agg(
            F.min(F.struct((-F.col(score)).alias("s"), F.col(row_id).alias("i"), F.col("_key").alias("k"))).alias("_l")
        )
        lead = cut(lead)
        took = lead.select(by, F.col("_l.i").alias(row_id), F.lit(step).alias("rank"))
        chosen = took if chosen is None else chosen.unionByName(took)
        if step == k:
            break
        left = left.join(lead.select(by, F.col("_l.k").alias("_seen")), by)
        shared = F.length("_key") - F.length(F.expr("translate(_key, _seen, '')"))
        left = cut(left.filter(~(shared > F.length("_key") * overlap)).drop("_seen"))
        if left.isEmpty():
            break
    return rows.join(chosen, [by, row_id])


def rank_and_number(
    rows: DataFrame, by: str, order: Sequence[Column], id_name: str = "demand_id", infix: str = "_demand_", pad: int = 3
) -> DataFrame:
    """Composite sort within ``by``; adds ``rank`` and ids such as ``<by>_demand_007``."""
    ranked = number_rows(rows, [by], order)
    text = F.col("rank").cast("string")
    shown = F.when(F.length(text) < pad, F.lpad(text, pad, "0")).otherwise(text)
    return ranked.withColumn(id_name, F.concat(F.col(by), F.lit(infix), shown))


def number_nested(items: Column | str, prefix: Column, pad: int = 3) -> Column:
    """Ids for nested items: ``<prefix>_sample_001`` beside each element of an array."""
    return F.transform(
        col(items),
        lambda x, i: F.struct(
            F.concat(prefix, F.lit("_sample_"), F.lpad((i + 1).cast("string"), pad, "0")).alias("id"), x.alias("item")
        ),
    )


def coded_order(c: Column | str, names: Sequence[str]) -> Column:
    """Position of a value in a custom order, unknown values last."""
    out = F.lit(len(names))
    for i, n in reversed(list(enumerate(names))):
        out = F.when(col(c) == n, i).otherwise(out)
    return out


def ordered_sections(rows: DataFrame, section: str, names: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Sections in a custom order, then ``order``; ``rank`` runs on across sections."""
    coded = rows.withColumn("_section", coded_order(section, names))
    return number_rows(coded, [], [F.col("_section"), F.col(section), *order]).drop("_section")


def representative_quotes(rows: DataFrame, by: str, text: str, order: str, within: int = 10, n: int = 5, chars: int = 200) -> DataFrame:
    """Within the first rows of a group, the first ``n`` different texts, truncated."""
    head = top_k(rows, [by], [order], within, "_h").filter(F.coalesce(F.col(text), F.lit("")) != "")
    first = top_k(head, [by, text], ["_h"], 1, "_d")
    picked = top_k(first, [by], ["_h"], n)
    return picked.withColumn("quote", F.substring(text, 1, chars)).drop("_h", "_d")


def rating_mix_pack(
    rows: DataFrame, by: str, rating: str, order: str, fields: Sequence[str], low: int = 200, high: int = 50, at_most: int = 3
) -> DataFrame:
    """One JSON document per group: the first ``low`` rows rated up to ``at_most`` and ``high`` others."""
    band = F.when(F.coalesce(F.col(rating), F.lit(5)) <= at_most, 0).otherwise(1)
    kept = top_k(rows.withColumn("_band", band), [by, "_band"], [order], max(low, high), "_r")
    kept = kept.filter(F.col("_r") <= F.when(F.col("_band") == 0, low).otherwise(high))
    item = F.struct("_band", "_r", F.struct(*fields).alias("x"))
    packed = F.transform(F.array_sort(F.collect_list(item)), lambda e: e["x"])
    return kept.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.to_json(packed).alias("document"))


def review_lines_pack(
    rows: DataFrame, by: str, app: str, rating: str, text: str, order: str, n: int = 100, min_chars: int = 20, chars: int = 150
) -> DataFrame:
    """One text per group: the first ``n`` low-rated, not too short rows as ``[app][rating] text`` lines."""
    low = rows.filter((F.coalesce(F.col(rating), F.lit(5)) <= 3) & (F.length(text) >= min_chars))
    kept = top_k(low, [by], [order], n, "_r")
    line = F.format_string("[%s][%d] %s", F.col(app), F.col(rating), F.substring(F.replace(F.col(text), F.lit("\n"), F.lit(" ")), 1, chars))
    packed = F.array_sort(F.collect_list(F.struct("_r", line.alias("x"))))
    return kept.groupBy(by).agg(F.array_join(F.transform(packed, lambda e: e["x"]), "\n").alias("document"))


# ---------------------------------------------------------------- spread over time


def _spread_first(pdf: pd.DataFrame) -> pd.DataFrame:
    """One pick per segment, preferring apps not used yet.  At most k*k rows come in."""
    used: set[str] = set()
    picks = []
    for _, seg in pdf.sort_values(["segment", "arrival"]).groupby("segment", sort=True):
        fresh = seg[~seg["app"].isin(used)]
        row = fresh.iloc[0] if len(fresh) else seg.iloc[0]
        if len(fresh):
            used.add(row["app"])
        picks.append(row)
    return pd.DataFrame(picks, columns=pdf.columns)


def time_stratified_sample(
    rows: DataFrame, topic: str, row_id: str, app: str, ts: str, arrival: str, start: Column, days: int, k: int = 5
) -> DataFrame:
    """``k`` rows per topic spread over ``days`` days from ``start``.

    The span is cut into k equal segments.  Each segment gives its first row, preferring apps not
    used by earlier segments.  If fewer than k were found, rows are taken at even steps from the
    remainder in time order, preferring unused apps until one place is left.

    Only the first row per (topic, segment, app), and of those the first k per segment, can be
    picked in the first pass; only rows at multiples of the step in the second.  These few rows
    per topic go to pandas.
    """
    seg_seconds = (days // k) * 86400
    base = rows.select(
        F.col(topic).alias("topic"), F.col(row_id).alias("row_id"), F.coalesce(F.col(app), F.lit("")).alias("app"),
        F.col(ts).alias("ts"), F.col(arrival).alias("arrival"),
    )
    seconds = F.col("ts").cast("bigint") - start.cast("bigint")
    # Read four times below: whatever judged the rows is not done again.
    base = cut(base.filter((seconds >= 0) & (seconds <= days * 86400)).withColumn(
        "segment", F.floor(seconds / seg_seconds).cast("int")
    ))
    inside = base.filter(F.col("segment") < k)
    per_app = top_k(inside, ["topic", "segment", "app"], ["arrival"], 1, "_a").drop("_a")
    few = top_k(per_app, ["topic", "segment"], ["arrival"], k, "_s").drop("_s")
    schema = few.schema
    first = cut(few.groupBy("topic").applyInPandas(_spread_first, schema))
    found = first.groupBy("topic").agg(F.count(F.lit(1)).alias("_took"), F.collect_set("app").alias("_used"))
    # A topic may have rows after the last whole segment only: it starts the second pass with nothing.
    took = base.select("topic").distinct().join(found, "topic", "left").select(
        "topic", F.coalesce("_took", F.lit(0)).alias("took"), F.coalesce("_used", F.array().cast("array<string>")).alias("used")
    )
    short = base.join(took.filter(F.col("took") < k), "topic").join(first.select("topic", "row_id"), ["topic", "row_id"], "left_anti")
    numbered = number_rows(short.drop("used"), ["topic"], [F.col("ts"), F.col("arrival"), F.col("row_id")], "_n")
    sizes = numbered.groupBy("topic").agg(F.count(F.lit(1)).alias("_rest"))
    step = F.greatest(F.lit(1), F.floor(F.col("_rest") / (k - F.col("took"))))
    at_step = numbered.join(sizes, "topic").filter((F.col("_n") - 1) % step == 0).join(took.select("topic", "used"), "topic")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        used, have = set(pdf["used"].iloc[0]), int(pdf["took"].iloc[0])
        keep = []
        for row in pdf.sort_values("_n").itertuples(index=False):
            if have >= k:
                break
            if row.app not in used or have >= k - 1:
                used.add(row.app)
                have += 1
                keep.append(row)
        return pd.DataFrame(keep, columns=pdf.columns)[["topic", "row_id", "app", "ts", "arrival", "segment"]]

    second = at_step.groupBy("topic").applyInPandas(fill, schema)
    return first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))


def refresh_evidence(evidence: DataFrame, fresh: DataFrame, demand: str, at_least: int = 3) -> DataFrame:
    """Replace a demand's evidence by ``fresh`` rows, but only when there are enough of them."""
    fresh = cut(fresh)
    enough = fresh.groupBy(demand).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least).select(demand)
    return evidence.join(enough, demand, "left_anti").unionByName(fresh.join(enough, demand))


def merge_evidence_pools(pools: Sequence[DataFrame], by: str, text: str, quality: str, k: int = 5, min_quality: float = 2.0) -> DataFrame:
    """Rows of several pools, earlier pools first, distinct by text; the ``k`` best by quality.

    Each pool has a ``pool_rank`` column giving its own order.
    """
    all_rows = None
    for i, p in enumerate(pools):
        tagged = p.filter(F.col(quality) > min_quality).withColumn("pool", F.lit(i))
        all_rows = tagged if all_rows is None else all_rows.unionByName(tagged, allowMissingColumns=True)
    hashed = all_rows.withColumn("_key", F.sha2(text, 256))
    distinct = dedupe_first(hashed, [by, "_key"], ["pool", "pool_rank"]).drop("_key")
    return top_k(distinct, [by], [F.desc(quality), F.col("pool"), F.col("pool_rank")], k)


def display_name(names: Mapping[str, str], c: Column | str) -> Column:
    """Display names of sources; unknown ones stay."""
    out = col(c)
    for k, v in names.items():
        out = F.when(col(c) == k, F.lit(v)).otherwise(out)
    return out
