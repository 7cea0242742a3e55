"""Scores and priorities: plain column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of, col, count_present, has_any, trim_all

# Weights of the final score and intensity of each sentiment.
WEIGHT_IMPORTANCE, WEIGHT_AI, WEIGHT_COMMONALITY = 0.30, 0.40, 0.30
INTENSITY = {
    "angry": 1.0,
    "disgusted": 1.0,
    "frustrated": 0.7,
    "disappointed": 0.5,
    "suggesting": 0.3,
    "neutral": 0.1,
}
INTENSITY_UNKNOWN = 0.5
TIER_BONUS = {1: 0.5, 2: 0.0, 3: -0.5}
# Sentiment to displayed score.
SENTIMENT_SCORE = {
    "angry": 0.9,
    "frustrated": 0.7,
    "disappointed": 0.5,
    "neutral": 0.0,
    "suggesting": 0.3,
    "disgusted": 0.9,
}


def _clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(c, F.lit(float(hi))), F.lit(float(lo)))


def mean_intensity(sentiments: Column | str, intensity: Mapping[str, float] = INTENSITY) -> Column:
    """Mean intensity over a sentiment -> count map; an empty map counts as total 1."""
    table = F.create_map(*[F.lit(x) for kv in intensity.items() for x in kv])
    entries = F.map_entries(F.coalesce(col(sentiments), F.create_map().cast("map<string,bigint>")))
    total = F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["value"])
    heat = F.aggregate(
        entries,
        F.lit(0.0),
        lambda a, e: a + F.coalesce(F.try_element_at(table, e["key"]), F.lit(INTENSITY_UNKNOWN)) * e["value"],
    )
    return heat / F.when(total == 0, 1.0).otherwise(total)


def importance_score(size: Column | str, avg_weight: Column | str, intensity: Column, tier: Column | str) -> Column:
    """Size on a log scale, low ratings, heat of the wording and tier; 0..10."""
    bonus = F.lit(0.0)
    for k, v in TIER_BONUS.items():
        bonus = F.when(col(tier) == k, v).otherwise(bonus)
    mass = F.least(F.log1p(col(size)) * 1.5, F.lit(6.0))
    return _clamp(mass + _clamp((5 - col(avg_weight)) / 2, 0, 2) + intensity * 1.5 + bonus, 0, 10)


def ai_relevance_score(ai: Column | str) -> Column:
    return F.least(col(ai) + F.when(col(ai) >= 7, 0.5).otherwise(0.0), F.lit(10.0))


def commonality_score(products: Column, sources: Column) -> Column:
    """From the number of distinct products and sources."""
    spread = F.least(F.log1p(products) * 3, F.lit(7.0))
    return F.least(spread + (sources - 1) * 1.5, F.lit(10.0))


def final_scores(importance: Column, ai: Column, commonality: Column) -> dict[str, Column]:
    """The four published scores, rounded to two places."""
    total = importance * WEIGHT_IMPORTANCE + ai * WEIGHT_AI + commonality * WEIGHT_COMMONALITY
    return {
        "final_score": F.bround(total, 2),
        "importance_score": F.bround(importance, 2),
        "ai_relevance_score": F.bround(ai, 2),
        "commonality_score": F.bround(commonality, 2),
    }


def priority(policy: str, **by: Column) -> Column:
    """Priority label under one of five policies.

    ``tier_ai`` (tier, ai); ``any_high`` and ``both_high`` (mentions, ai); ``points`` (mentions,
    avg_rating, sources); ``value`` (mentions, value).
    """
    if policy == "tier_ai":
        tier, ai = by["tier"], by["ai"]
        return (
            F.when((tier == 1) & (ai >= 7), "P0").when((tier == 1) | ((tier == 2) & (ai >= 6)), "P1").otherwise("P2")
        )
    if policy == "any_high":
        m, ai = by["mentions"], by["ai"]
        return (
            F.when((m >= 50) | (ai >= 8), "P0")
            .when((m >= 20) | (ai >= 6), "P1")
            .when((m >= 5) | (ai >= 4), "P2")
            .otherwise("P3")
        )
    if policy == "both_high":
        m, ai = by["mentions"], by["ai"]
        return (
            F.when((m >= 20) & (ai >= 7), "P0").when((m >= 10) | (ai >= 6), "P1").when(m >= 5, "P2").otherwise("P3")
        )
    if policy == "points":
        p = priority_points(by["mentions"], by["avg_rating"], by["sources"])
        return F.when(p >= 70, "P0").when(p >= 50, "P1").when(p >= 30, "P2").otherwise("P3")
    if policy == "value":
        m, high = by["mentions"], by["value"] == "high"
        return F.when((m >= 100) & high, "P0").when((m >= 50) | ((m >= 20) & high), "P1").otherwise("P2")
    raise ValueError(f"unknown policy {policy}")


# Points by number of mentions and by average rating.
MENTION_POINTS = [(100, 40), (50, 30), (20, 20), (10, 15), (5, 10)]
RATING_POINTS = [(1.5, 30), (2.0, 25), (2.5, 20), (3.0, 15)]


def priority_points(mentions: Column, avg_rating: Column, sources: Column) -> Column:
    count_part = F.lit(5)
    for least, pts in reversed(MENTION_POINTS):
        count_part = F.when(mentions >= least, pts).otherwise(count_part)
    rating_part = F.lit(0)
    for most, pts in reversed(RATING_POINTS):
        rating_part = F.when(avg_rating <= most, pts).otherwise(rating_part)
    rating_part = F.when(avg_rating.isNull(), 15).otherwise(rating_part)
    return count_part + rating_part + F.least(sources * 10, F.lit(20))


def composite_score(ai: Column, mentions: Column, low_share: Column, full_at: int = 72) -> Column:
    """0.4 AI score, 0.3 mentions (10 at ``full_at``), 0.3 share of low ratings (0..1 scaled to 10)."""
    return ai * 0.4 + F.least(mentions / full_at * 10, F.lit(10.0)) * 0.3 + low_share * 10 * 0.3


def vote_weight(points: Column | str) -> Column:
    return F.least(F.coalesce(col(points), F.lit(0)) / 10 + 1, F.lit(5.0))


def blend_score(quality: Column, relevance: Column) -> Column:
    return quality * 0.6 + F.least(relevance * 2, F.lit(10)) * 0.4


def sample_score(
    text: Column | str,
    sentiment: Column,
    relevance: Column,
    title: Column,
    scenario: Sequence[str],
    problems: Sequence[str],
    wishes: Sequence[str],
    rants: Sequence[str],
    vague: Sequence[str],
    linked: Sequence[tuple[str, Sequence[str]]],
    stops: Sequence[str] = (".", ","),
) -> Column:
    """Quality of an evidence text; ``linked`` maps a word of the title to words expected in the text."""
    s = col(text)
    n = F.length(s)
    link = F.lit(0.0)
    for word, expected in reversed(list(linked)):
        link = F.when(title.contains(word), F.when(has_any(s, expected), 2.0).otherwise(0.0)).otherwise(link)
    unpunctuated = (n < 30) & ~has_any(s, stops)
    return (
        F.coalesce(relevance, F.lit(0.0)) * 0.5
        + F.when(n.between(50, 200), 3.0).when(n.between(30, 300), 2.0).when(n > 10, 1.0).otherwise(0.0)
        + F.when(has_any(s, scenario), 1.0).otherwise(0.0)
        + F.least(count_present(s, problems) * 0.8, F.lit(3.0))
        + F.when(F.coalesce(sentiment, F.lit(0.5)).between(0.3, 0.7), 1.0).otherwise(0.0)
        + F.when(has_any(s, wishes), 1.5).otherwise(0.0)
        - F.when(trim_all(s).rlike(f"^(?:{any_of(rants)})"), 3.0).otherwise(0.0)
        - F.when(n < 15, 2.0).when(unpunctuated, 1.0).otherwise(0.0)
        - F.when(has_any(s, vague), 1.5).otherwise(0.0)
        + link
    )


def sample_score_simple(
    text: Column | str, wishes: Sequence[str], scenario: Sequence[str], strong: Sequence[str]
) -> Column:
    """The shorter variant: length, a wish, a scene, strong wording."""
    s = col(text)
    n = F.length(s)
    return (
        F.when(n.between(30, 200), 3).when(n > 200, 1).otherwise(0)
        + F.when(has_any(s, wishes), 2).otherwise(0)
        + F.when(has_any(s, scenario), 2).otherwise(0)
        + F.when(has_any(s, strong), 1).otherwise(0)
    )


def product_coverage(products: Column | str) -> Column:
    """Struct(top_share, count, dirty, cross) of a product -> count map."""
    entries = F.map_entries(F.coalesce(col(products), F.create_map().cast("map<string,bigint>")))
    counts = F.transform(entries, lambda e: e["value"])
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, v: a + v)
    return coverage_of(F.array_max(counts), total, F.size(counts))


def coverage_of(top: Column, total: Column, n: Column) -> Column:
    """The same from already aggregated numbers: largest count, total, number of products."""
    empty = F.coalesce(n, F.lit(0)) == 0
    share = F.when(empty, 1.0).otherwise(top / F.when(total == 0, 1).otherwise(total))
    cnt = F.when(empty, 0).otherwise(n)
    return F.struct(
        share.alias("top_share"),
        cnt.cast("bigint").alias("product_count"),
        (~empty & (share < 0.40) & (cnt > 6)).alias("dirty"),
        (~empty & (share < 0.70) & (cnt >= 3)).alias("cross_product"),
    )
