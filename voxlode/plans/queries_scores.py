"""Queries over scores and priorities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores
from ..functions.text import map_value
from ..operators import aggregates as A
from ..operators import tagging
from ..sources.tables import ATOMS_SQL, COMMENTS_SQL, REVIEWS_SQL, SENTIMENTS, atoms, comments, reviews, table
from . import bindings as B
from .queries_quality import _sql_sample
from .registry import query


def demand_stats(spark, d):
    """Demands as (category, label) groups of atoms with the numbers the scores need."""
    a = atoms(spark, d)
    return a.groupBy("category", "label").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("weight_signal").alias("avg_weight"),
        F.avg(map_value("sentiment", scores.INTENSITY, 0.5)).alias("heat"),
        F.countDistinct("product").alias("products"),
        F.countDistinct("source").alias("sources"),
    ).withColumns({"tier": F.col("label") % 3 + 1, "ai": F.col("label") + 1})


_HEAT = "CASE sentiment " + " ".join(f"WHEN {B.q(k)} THEN {v}" for k, v in scores.INTENSITY.items()) + " ELSE 0.5 END"
STATS_SQL = f"""
SELECT category, label, count(*) AS size, avg(weight_signal) AS avg_weight, avg({_HEAT}) AS heat,
       count(DISTINCT product) AS products, count(DISTINCT source) AS sources, label % 3 + 1 AS tier, label + 1 AS ai
FROM ({ATOMS_SQL}) GROUP BY category, label"""
_IMP = """greatest(0, least(10, least(ln(1 + size) * 1.5, 6) + greatest(0, least((5 - avg_weight) / 2, 2)) + heat * 1.5
  + CASE tier WHEN 1 THEN 0.5 WHEN 3 THEN -0.5 ELSE 0 END))::DOUBLE"""
_AI = "least(ai + CASE WHEN ai >= 7 THEN 0.5 ELSE 0 END, 10)::DOUBLE"
_COM = "least(least(ln(1 + products) * 3, 7) + (sources - 1) * 1.5, 10)::DOUBLE"


@query("importance_score", "E1", f"SELECT category, label, round({_IMP}, 4) AS importance FROM ({STATS_SQL})")
def importance_score(spark, d):
    # The intensity comes from the distribution map here, as a served row would carry it.
    a = atoms(spark, d)
    dist = A.distribution_map(a, ["category", "label"], "sentiment", len(SENTIMENTS))
    s = demand_stats(spark, d).join(dist, ["category", "label"])
    score = scores.importance_score("size", "avg_weight", scores.mean_intensity("dist"), "tier")
    return s.select("category", "label", F.round(score, 4).alias("importance"))


@query("ai_relevance_score", "E2", f"SELECT category, label, {_AI} AS ai_relevance FROM ({STATS_SQL})")
def ai_relevance_score(spark, d):
    return demand_stats(spark, d).select("category", "label", scores.ai_relevance_score("ai").alias("ai_relevance"))


@query("commonality_score", "E3", f"SELECT category, label, round({_COM}, 4) AS commonality FROM ({STATS_SQL})")
def commonality_score(spark, d):
    return demand_stats(spark, d).select(
        "category", "label", F.round(scores.commonality_score(F.col("products"), F.col("sources")), 4).alias("commonality")
    )


@query("final_score", "E4", f"""
SELECT category, label, round_even(round({_IMP}, 9), 2)::DOUBLE AS importance_score, round_even({_AI}, 2)::DOUBLE AS ai_relevance_score,
  round_even(round({_COM}, 9), 2)::DOUBLE AS commonality_score,
  round_even(round({_IMP} * 0.3 + {_AI} * 0.4 + {_COM} * 0.3, 9), 2)::DOUBLE AS final_score FROM ({STATS_SQL})""")
def final_score(spark, d):
    s = demand_stats(spark, d)
    imp = F.round(scores.importance_score("size", "avg_weight", F.col("heat"), "tier"), 9)
    com = F.round(scores.commonality_score(F.col("products"), F.col("sources")), 9)
    parts = scores.final_scores(imp, scores.ai_relevance_score("ai"), com)
    return s.select("category", "label", *[v.alias(k) for k, v in parts.items()])


@query("priority", "E5", f"""
WITH s AS (SELECT *, CASE WHEN label % 2 = 0 THEN 'high' ELSE 'low' END AS value,
   5 + CASE WHEN size >= 100 THEN 35 WHEN size >= 50 THEN 25 WHEN size >= 20 THEN 15 WHEN size >= 10 THEN 10 WHEN size >= 5 THEN 5 ELSE 0 END
     + CASE WHEN avg_weight <= 1.5 THEN 30 WHEN avg_weight <= 2 THEN 25 WHEN avg_weight <= 2.5 THEN 20 WHEN avg_weight <= 3 THEN 15 ELSE 0 END
     + least(sources * 10, 20) AS pts FROM ({STATS_SQL}))
SELECT category, label,
  CASE WHEN tier = 1 AND ai >= 7 THEN 'P0' WHEN tier = 1 OR (tier = 2 AND ai >= 6) THEN 'P1' ELSE 'P2' END AS tier_ai,
  CASE WHEN size >= 50 OR ai >= 8 THEN 'P0' WHEN size >= 20 OR ai >= 6 THEN 'P1' WHEN size >= 5 OR ai >= 4 THEN 'P2' ELSE 'P3' END AS any_high,
  CASE WHEN size >= 20 AND ai >= 7 THEN 'P0' WHEN size >= 10 OR ai >= 6 THEN 'P1' WHEN size >= 5 THEN 'P2' ELSE 'P3' END AS both_high,
  CASE WHEN pts >= 70 THEN 'P0' WHEN pts >= 50 THEN 'P1' WHEN pts >= 30 THEN 'P2' ELSE 'P3' END AS points,
  CASE WHEN size >= 100 AND value = 'high' THEN 'P0' WHEN size >= 50 OR (size >= 20 AND value = 'high') THEN 'P1' ELSE 'P2' END AS by_value
FROM s""")
def priority(spark, d):
    s = demand_stats(spark, d)
    m, ai = F.col("size"), F.col("ai")
    high = F.when(F.col("label") % 2 == 0, "high").otherwise("low")
    return s.select(
        "category", "label",
        scores.priority("tier_ai", tier=F.col("tier"), ai=ai).alias("tier_ai"),
        scores.priority("any_high", mentions=m, ai=ai).alias("any_high"),
        scores.priority("both_high", mentions=m, ai=ai).alias("both_high"),
        scores.priority("points", mentions=m, avg_rating=F.col("avg_weight"), sources=F.col("sources")).alias("points"),
        scores.priority("value", mentions=m, value=high).alias("by_value"),
    )


@query("composite_score", "E6", f"""
SELECT category, app_name, round((rating_n % 10) * 0.4 + least(n / 12.0 * 10, 10) * 0.3 + low * 10 * 0.3, 4) AS composite
FROM (SELECT category, app_name, count(*) AS n, sum(rating) AS rating_n, avg(CASE WHEN rating <= 2 THEN 1.0 ELSE 0.0 END) AS low
      FROM ({REVIEWS_SQL}) GROUP BY category, app_name)""")
def composite_score(spark, d):
    g = reviews(spark, d).groupBy("category", "app_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rn"), F.avg((F.col("rating") <= 2).cast("double")).alias("low")
    )
    score = scores.composite_score(F.col("rn") % 10, F.col("n"), F.col("low"), full_at=12)
    return g.select("category", "app_name", F.round(score, 4).alias("composite"))


_SC = dict(
    scenario=["was ", "ist ", "est "], problems=["ing", "ung", "tion", "keit", "ment"], wishes=["for", "pour", "para"],
    rants=["That", "Der", "De"], vague=["idiot", "are"],
)
_LINKED = [("1", ["with", "mit"]), ("2", ["the", "que"])]


@query("sample_score", "E7", f"""
SELECT id, round(rating * 0.5
  + CASE WHEN length(c) BETWEEN 50 AND 200 THEN 3 WHEN length(c) BETWEEN 30 AND 300 THEN 2 WHEN length(c) > 10 THEN 1 ELSE 0 END
  + CASE WHEN {B.sql_contains_any('c', _SC['scenario'])} THEN 1 ELSE 0 END
  + least({B.sql_count_present('c', _SC['problems'])} * 0.8, 3)
  + CASE WHEN rating / 5.0 BETWEEN 0.3 AND 0.7 THEN 1 ELSE 0 END
  + CASE WHEN {B.sql_contains_any('c', _SC['wishes'])} THEN 1.5 ELSE 0 END
  - CASE WHEN regexp_matches({B.sql_trim('c')}, '^(?:That|Der|De)') THEN 3 ELSE 0 END
  - CASE WHEN length(c) < 15 THEN 2 WHEN NOT contains(c, '.') AND NOT contains(c, ',') AND length(c) < 30 THEN 1 ELSE 0 END
  - CASE WHEN {B.sql_contains_any('c', _SC['vague'])} THEN 1.5 ELSE 0 END
  + CASE WHEN contains(app_name, '1') THEN CASE WHEN {B.sql_contains_any('c', ['with', 'mit'])} THEN 2 ELSE 0 END
         WHEN contains(app_name, '2') THEN CASE WHEN {B.sql_contains_any('c', ['the', 'que'])} THEN 2 ELSE 0 END ELSE 0 END, 4)::DOUBLE AS score,
  CASE WHEN length(c) BETWEEN 30 AND 200 THEN 3 WHEN length(c) > 200 THEN 1 ELSE 0 END
  + CASE WHEN {B.sql_contains_any('c', _SC['wishes'])} THEN 2 ELSE 0 END + CASE WHEN {B.sql_contains_any('c', _SC['scenario'])} THEN 2 ELSE 0 END
  + CASE WHEN {B.sql_contains_any('c', ['this', 'sehr', 'muy', 'with'])} THEN 1 ELSE 0 END AS simple
FROM (SELECT *, content AS c FROM ({REVIEWS_SQL}))""")
def sample_score(spark, d):
    r = reviews(spark, d)
    score = scores.sample_score("content", F.col("rating") / 5, F.col("rating"), F.col("app_name"), linked=_LINKED, **_SC)
    simple = scores.sample_score_simple("content", _SC["wishes"], _SC["scenario"], ["this", "sehr", "muy", "with"])
    return r.select("id", F.round(score, 4).alias("score"), simple.alias("simple"))


def _sql_blend():
    rows = []
    for i, t, kw in B.DEMANDS:
        words = list(dict.fromkeys(B.title_terms(t) + kw))
        rows.append(f"SELECT k AS doc_id, {B.q(i)} AS demand_id, {_sql_sample(B.title_terms(t), kw)} AS quality, "
                    f"{B.sql_count_present('lower(x)', words)} AS relevance FROM quality")
    return " UNION ALL ".join(rows)


BLEND_SQL = f"""WITH {B.sql_quality_cte('documents', 'doc_id', 'text')}, b AS ({_sql_blend()})
SELECT doc_id, demand_id, quality, relevance, round(quality * 0.6 + least(relevance * 2, 10) * 0.4, 4)::DOUBLE AS blend
FROM b WHERE relevance > 0 AND quality > 2"""


def blended(spark, d):
    """Documents rated as evidence of each demand: quality, relevance and the blend of both."""
    from ..operators.evidence import rated_for_demands

    docs = table(spark, d, "documents").select("doc_id", "text")
    return rated_for_demands(docs, "text", B.DEMANDS, B.title_terms, B.QUALITY, B.SAMPLE)


@query("blend_score", "E8", BLEND_SQL)
def blend_score(spark, d):
    return blended(spark, d).select("doc_id", "demand_id", "quality", "relevance", F.round("blend", 4).alias("blend"))


@query("vote_weight", "E9", f"SELECT id, least(points / 10.0 + 1, 5)::DOUBLE AS weight FROM ({COMMENTS_SQL})")
def vote_weight(spark, d):
    return comments(spark, d).select("id", scores.vote_weight("points").alias("weight"))


@query("product_coverage", "E10", """
WITH c AS (SELECT l_suppkey, p_brand, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
s AS (SELECT l_suppkey, max(n) / sum(n) AS share, count(*) AS k FROM c GROUP BY l_suppkey)
SELECT l_suppkey, round(share, 4)::DOUBLE AS top_share, CAST(k AS BIGINT) AS product_count, share < 0.4 AND k > 6 AS dirty, share < 0.7 AND k >= 3 AS cross_product FROM s""")
def product_coverage(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").join(part, "l_partkey")
    by_brand = A.distribution(li, ["l_suppkey"], "p_brand")
    s = by_brand.groupBy("l_suppkey").agg(
        scores.coverage_of(F.max("n"), F.sum("n"), F.count(F.lit(1))).alias("c")
    )
    return s.select("l_suppkey", F.round("c.top_share", 4).alias("top_share"), "c.product_count", "c.dirty", "c.cross_product")


@query("product_coverage_map", "E10 G1", f"""
WITH c AS (SELECT category, label, product, count(*) AS n FROM ({ATOMS_SQL}) GROUP BY ALL),
s AS (SELECT category, label, max(n) / sum(n) AS share, count(*) AS k FROM c GROUP BY category, label)
SELECT category, label, round(share, 4)::DOUBLE AS top_share, share < 0.4 AND k > 6 AS dirty, share < 0.7 AND k >= 3 AS cross_product FROM s""")
def product_coverage_map(spark, d):
    dist = A.distribution_map(atoms(spark, d), ["category", "label"], "product", 100)
    c = dist.select("category", "label", scores.product_coverage("dist").alias("c"))
    return c.select("category", "label", F.round("c.top_share", 4).alias("top_share"), "c.dirty", "c.cross_product")
