"""Flagship: recent, good reviews tagged with demands, scored, ranked in sections, with quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import recent_only
from ..functions.quality import QualityRules, assess_quality
from ..functions.scores import composite_score
from ..functions.text import truncate
from ..lexicon import Rule
from ..operators.ranking import coded_order, top_k
from ..operators.tagging import match_rules
from ..session import cut
from ..sources.tables import REVIEWS_SQL, reviews
from . import bindings as B
from .registry import query


def rank_demands(
    rows: DataFrame, rules: Sequence[Rule], quality: QualityRules, cutoff: str, sections: Sequence[str], quotes: int = 3, full_at: int = 72
) -> DataFrame:
    """One row per (demand, quote): section, title, mentions, low-rating share, composite score and quote.

    ``rows``: id, rating, date, content.  The texts are read and judged once: the narrow hits (with the quote already
    cut) are stored, then counted and ranked per rule, both reduced in the map tasks.
    """
    recent = rows.filter(recent_only("date", cutoff))
    good = assess_quality(recent, "content", quality).filter("keep")
    matched = match_rules(good.select("id", "rating", "content"), "content", rules)
    hits = cut(matched.select("id", "rating", "rule_id", "rule_ord", "relevance", truncate("content", 250).alias("quote")))
    stats = hits.groupBy("rule_id", "rule_ord").agg(
        F.count(F.lit(1)).alias("mentions"), F.avg((F.col("rating") <= 2).cast("double")).alias("low_share")
    )

    def attr(f):
        return F.coalesce(*[F.when(F.col("rule_ord") == i, F.lit(f(r))) for i, r in enumerate(rules)])

    stats = stats.select(
        "rule_id", "mentions", "low_share", attr(lambda r: r.kind).alias("section"), attr(lambda r: r.label).alias("title"), attr(lambda r: r.score).alias("ai_score")
    ).withColumn("composite", composite_score(F.col("ai_score"), F.col("mentions"), F.col("low_share"), full_at))
    best = top_k(hits, ["rule_id"], [F.desc("relevance"), "rating", "id"], quotes, "quote_no")
    said = best.select("rule_id", "quote_no", "id", "quote")
    return stats.join(said, "rule_id").withColumn("section_no", coded_order("section", sections))


SECTIONS = ["feature", "problem", "policy"]


def demand_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir).select("id", "rating", "date", "content")
    out = rank_demands(r, B.RULES, B.QUALITY, "2024-02-01", SECTIONS)
    return out.select(
        "section_no", "section", "rule_id", "title", "mentions", F.round("low_share", 4).alias("low_share"),
        F.round("composite", 4).alias("composite"), "quote_no", "id", "quote",
    )


_HITS = B.sql_rule_rows(
    lambda r, i: f"SELECT {B.q(r.rule_id)} AS rule_id, {B.q(r.kind)} AS section, {B.q(r.label)} AS title, {r.score} AS ai, id, rating, content, "
    f"{B.sql_count_present('content', r.relevance)} AS relevance FROM good WHERE {B.sql_match('content', r)}"
)


@query("demand_report", "C12 C3 D3 G6 E6 H12 H11", f"""
WITH r AS ({REVIEWS_SQL}), {B.sql_quality_cte('r', 'id', 'content')},
good AS (SELECT r.* FROM r JOIN quality q ON q.k = r.id WHERE q.score >= 2
  AND TRY_CAST(CASE WHEN length(r.date) = 10 THEN r.date || 'T00:00:00Z' ELSE r.date END AS TIMESTAMPTZ) >= TIMESTAMPTZ '2024-02-01 00:00:00+00'),
h AS ({_HITS}),
s AS (SELECT rule_id, section, title, ai, count(*) AS mentions, avg(CASE WHEN rating <= 2 THEN 1.0 ELSE 0.0 END) AS low FROM h GROUP BY rule_id, section, title, ai),
t AS (SELECT rule_id, id, content, row_number() OVER (PARTITION BY rule_id ORDER BY relevance DESC, rating, id) AS n FROM h QUALIFY n <= 3)
SELECT CASE section WHEN 'feature' THEN 0 WHEN 'problem' THEN 1 ELSE 2 END AS section_no, section, rule_id, title, CAST(mentions AS BIGINT) AS mentions,
  round(low, 4)::DOUBLE AS low_share, round(ai * 0.4 + least(mentions / 72.0 * 10, 10) * 0.3 + low * 10 * 0.3, 4)::DOUBLE AS composite, CAST(n AS INTEGER) AS quote_no, id,
  {B.sql_truncate('content', 250)} AS quote FROM s JOIN t USING (rule_id)""")
def _report(spark, d):
    return demand_report(spark, d)
