"""Queries that rank, sample and deduplicate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, quality, text
from ..operators import evidence as E
from ..operators import ranking as R
from ..operators import tagging
from ..sources.tables import ATOMS_SQL, REVIEWS_SQL, atoms, reviews, table
from . import bindings as B
from .queries_scores import BLEND_SQL, STATS_SQL, blended, demand_stats
from .registry import query


def _rated_atoms(spark, d):
    r = quality.assess_quality(reviews(spark, d).select("id", "rating", "content"), "content", B.QUALITY)
    q = r.select(F.col("id").alias("source_review_id"), "rating", "quality_score")
    return atoms(spark, d).withColumn("demand_id", F.col("label")).join(q, "source_review_id")


@query("top_evidence", "H1", f"""
WITH {B.sql_quality_cte(f'({REVIEWS_SQL})', 'id', 'content')},
a AS (SELECT a.label AS demand_id, a.source_review_id, a.source, a.weight_signal, r.rating, q.score,
        row_number() OVER (PARTITION BY a.label, a.source_review_id ORDER BY a.pos) AS f
      FROM ({ATOMS_SQL}) a JOIN ({REVIEWS_SQL}) r ON r.id = a.source_review_id JOIN quality q ON q.k = r.id),
s AS (SELECT *, CASE WHEN source = 'forum' THEN weight_signal ELSE 6 - rating END AS st FROM a WHERE f = 1)
SELECT demand_id, source_review_id, CAST(row_number() OVER (PARTITION BY demand_id ORDER BY st DESC, score DESC, source_review_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= 5""")
def top_evidence(spark, d):
    return R.top_evidence(_rated_atoms(spark, d)).select("demand_id", "source_review_id", "rank")


@query("top_evidence_star", "H1", """
SELECT l_suppkey, l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank
FROM lineitem QUALIFY rank <= 3""")
def top_evidence_star(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return R.top_k(li, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 3).drop("l_extendedprice")


@query("time_stratified_sample", "H3")
def time_stratified_sample(spark, d):
    return _spread(spark, d).select("topic", "row_id", "pass")


def _spread(spark, d):
    # The clean-up rules ask for short civil texts; whole texts are judged, none is cut.  They are judged before the join, which then carries none.
    topics = F.when(quality.is_civil("text", B.OFFENSIVE, B.EMOTIONAL), tagging.tag_all("text", B.RULES))
    r = reviews(spark, d, topics=topics).withColumn("ts", dates.parse_ts("date"))
    # With ``explode`` Spark would judge each text once more, to keep out those without topics.
    good = r.select("id", "app_name", "ts", "doc_id", F.explode_outer("topics").alias("topic")).filter("topic is not null")
    start = dates.parse_ts(F.lit("2024-01-01"))
    return R.time_stratified_sample(good, "topic", "id", "app_name", "ts", "doc_id", start, 365)


@query("round_robin", "H4", f"""
WITH r AS (SELECT *, regexp_matches(content, '[À-ÿ]') AS p FROM ({REVIEWS_SQL})),
e AS (SELECT * FROM r WHERE p OR app_name NOT IN (SELECT app_name FROM r WHERE p)),
t AS (SELECT app_name, channel, id, row_number() OVER (PARTITION BY app_name, channel ORDER BY doc_id) AS turn FROM e)
SELECT app_name, channel, id, CAST(row_number() OVER (PARTITION BY app_name ORDER BY turn, CASE channel WHEN 'play' THEN 0 WHEN 'store' THEN 1 ELSE 2 END) AS INTEGER) AS rank
FROM t QUALIFY rank <= 5""")
def round_robin(spark, d):
    r = reviews(spark, d)
    out = R.round_robin(r, "app_name", "channel", text.has_script("content", "À-ÿ"), ["doc_id"], ["play", "store"])
    return out.select("app_name", "channel", "id", "rank")


@query("proportional_sample", "H5", f"""
WITH r AS (SELECT category, doc_id, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS r, count(*) OVER (PARTITION BY category) AS c,
  min(doc_id) OVER (PARTITION BY category) AS f, count(*) OVER () AS t FROM ({REVIEWS_SQL}))
SELECT category, doc_id FROM (SELECT * FROM r WHERE r <= greatest(1, floor(60 * c / t)) ORDER BY f, r LIMIT 60)""")
def proportional_sample(spark, d):
    return R.proportional_sample(reviews(spark, d, rated=False).select("category", "doc_id"), "category", "doc_id", 60)


@query("capped_candidates", "H6", f"""
WITH s AS ({B.RULE_RELEVANCE_SQL}), f AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY doc_id) AS arrival FROM s WHERE relevance_score >= 3),
b AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY round(relevance_score, 6) DESC, arrival) AS rank FROM f WHERE arrival <= 50)
SELECT rule_id, doc_id, CAST(arrival AS INTEGER) AS arrival, CAST(rank AS INTEGER) AS rank, rank <= 5 AS shown FROM b WHERE rank <= 10""")
def capped_candidates(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    s = tagging.relevant_rules(docs, "text", B.RULES, B.RELEVANCE).select("rule_id", "doc_id", F.round("relevance_score", 6).alias("score"))
    return R.capped_candidates(s, "rule_id", ["doc_id"], "score").drop("score")


@query("dedupe_first", "H7", f"""
SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY substr(replace({B.sql_trim('text')}, chr(10), ' '), 1, 50) ORDER BY doc_id) = 1""")
def dedupe_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.content_key("text").alias("key"))
    return R.dedupe_first(docs, ["key"], ["doc_id"]).select("doc_id")


@query("dedupe_near", "H8")
def dedupe_near(spark, d):
    r = reviews(spark, d, rated=False).select("id", "app_name", "content", F.length("content").cast("double").alias("score"))
    return R.dedupe_near(r, "app_name", "content", "score", "id").select("app_name", "id", "rank")


@query("rank_and_number", "H10", f"""
WITH r AS (SELECT category, label, CAST(row_number() OVER (PARTITION BY category ORDER BY tier, ai DESC, size DESC, label) AS BIGINT) AS rank FROM ({STATS_SQL}))
SELECT category, label, rank, category || '_demand_' || lpad(CAST(rank AS VARCHAR), 3, '0') AS demand_id FROM r""")
def rank_and_number(spark, d):
    s = demand_stats(spark, d)
    out = R.rank_and_number(s, "category", [F.col("tier"), F.desc("ai"), F.desc("size"), F.col("label")])
    return out.select("category", "label", "rank", "demand_id")


@query("rank_and_number_star", "H10", """
SELECT o_orderpriority, o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank FROM orders""")
def rank_and_number_star(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return R.number_rows(o, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")]).drop("o_totalprice")


@query("number_nested", "H10", """
SELECT lang || '_opp_' || source AS opp, unnest([lang || '_opp_' || source || '_sample_' || lpad(CAST(i AS VARCHAR), 3, '0') for i in range(1, n + 1)]) AS sample_id
FROM (SELECT lang, source, least(count(*), 5) AS n FROM documents GROUP BY lang, source)""")
def number_nested(spark, d):
    docs = table(spark, d, "documents").select("lang", "source", "doc_id")
    few = R.top_k(docs, ["lang", "source"], ["doc_id"], 5)
    g = few.groupBy("lang", "source").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    opp = F.concat_ws("_opp_", "lang", "source")
    return g.select(opp.alias("opp"), F.explode(R.number_nested("ids", opp)).alias("x")).select("opp", F.col("x.id").alias("sample_id"))


@query("ordered_sections", "H11", f"""
SELECT category, label, CAST(row_number() OVER (ORDER BY CASE category WHEN 'fr' THEN 0 WHEN 'en' THEN 1 ELSE 2 END, category, size DESC, label) AS BIGINT) AS rank FROM ({STATS_SQL})""")
def ordered_sections(spark, d):
    return R.ordered_sections(demand_stats(spark, d), "category", ["fr", "en"], [F.desc("size"), F.col("label")]).select("category", "label", "rank")


@query("best_samples_by_relevance", "H12", f"""
WITH m AS ({B.sql_rule_rows(lambda r, i: f"SELECT id, rating, {B.q(r.rule_id)} AS rule_id, {B.sql_count_present('content', r.relevance)} AS relevance FROM ({REVIEWS_SQL}) WHERE {B.sql_match('content', r)}")})
SELECT rule_id, id, CAST(row_number() OVER (PARTITION BY rule_id ORDER BY relevance DESC, rating, id) AS INTEGER) AS rank FROM m QUALIFY rank <= 3""")
def best_samples_by_relevance(spark, d):
    m = tagging.match_rules(reviews(spark, d).select("id", "rating", "content"), "content", B.RULES, carry=["id", "rating"])
    return R.top_k(m, ["rule_id"], [F.desc("relevance"), "rating", "id"], 3).select("rule_id", "id", "rank")


@query("representative_quotes", "H13", f"""
WITH l AS (SELECT doc_id, text, CASE {' '.join(f"WHEN {B.sql_contains_any('lower(text)', r.keywords)} THEN {B.q(r.label)}" for r in B.RULES)} END AS label FROM documents),
h AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS h FROM l WHERE label IS NOT NULL QUALIFY h <= 10),
f AS (SELECT label, text, min(h) AS h FROM h WHERE text <> '' GROUP BY label, text)
SELECT label, substr(text, 1, 200) AS quote, CAST(row_number() OVER (PARTITION BY label ORDER BY h) AS INTEGER) AS rank FROM f QUALIFY rank <= 5""")
def representative_quotes(spark, d):
    l = table(spark, d, "documents").select("doc_id", "text", tagging.tag_first("text", B.RULES).alias("label"))
    return R.representative_quotes(l.filter("label is not null"), "label", "text", "doc_id").select("label", "quote", "rank")


@query("rating_mix_pack", "H14", f"""
WITH r AS (SELECT category, app_name, author, rating, doc_id, CASE WHEN rating <= 3 THEN 0 ELSE 1 END AS band,
   row_number() OVER (PARTITION BY category, CASE WHEN rating <= 3 THEN 0 ELSE 1 END ORDER BY doc_id) AS r FROM ({REVIEWS_SQL}))
SELECT category, CAST(count(*) AS BIGINT) AS rows, '[' || string_agg('{{"app_name":"' || app_name || '","author":"' || author || '","rating":' || rating || '}}', ',' ORDER BY band, r) || ']' AS document
FROM r WHERE (band = 0 AND r <= 200) OR (band = 1 AND r <= 50) GROUP BY category""")
def rating_mix_pack(spark, d):
    return R.rating_mix_pack(reviews(spark, d), "category", "rating", "doc_id", ["app_name", "author", "rating"])


@query("review_lines_pack", "H14", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS r FROM ({REVIEWS_SQL}) WHERE rating <= 3 AND length(content) >= 20)
SELECT category, string_agg('[' || app_name || '][' || rating || '] ' || substr(replace(content, chr(10), ' '), 1, 150), chr(10) ORDER BY r) AS document
FROM r WHERE r <= 100 GROUP BY category""")
def review_lines_pack(spark, d):
    return R.review_lines_pack(reviews(spark, d), "category", "app_name", "rating", "content", "doc_id")


@query("refresh_evidence", "H15")
def refresh_evidence(spark, d):
    fresh = _spread(spark, d).select(F.col("topic").alias("demand_id"), "row_id", F.lit("fresh").alias("state"))
    old = tagging.match_rules(reviews(spark, d, rated=False).select("id", "content"), "content", B.RULES, carry=["id"])
    names = {r.rule_id: r.label for r in B.RULES}
    old = R.top_k(old.withColumn("demand_id", R.display_name(names, "rule_id")), ["demand_id"], ["id"], 5)
    return R.refresh_evidence(old.select("demand_id", F.col("id").alias("row_id"), F.lit("old").alias("state")), fresh, "demand_id")


@query("best_for_demands", "E8 H16", f"""
SELECT demand_id, doc_id, CAST(row_number() OVER (PARTITION BY demand_id ORDER BY blend DESC, doc_id) AS INTEGER) AS rank FROM ({BLEND_SQL}) QUALIFY rank <= 5""")
def best_for_demands(spark, d):
    rated = blended(spark, d).withColumn("blend", F.round("blend", 4))
    return E.best_for_demands(rated, "doc_id").select("demand_id", "doc_id", "rank")


@query("merge_evidence_pools", "H16", f"""
WITH rated AS ({BLEND_SQL}),
best AS (SELECT demand_id, r.doc_id, quality, 0 AS pool, row_number() OVER (PARTITION BY demand_id ORDER BY blend DESC, r.doc_id) AS pr, d.text, d.source FROM rated r JOIN documents d ON d.doc_id = r.doc_id QUALIFY pr <= 5),
earlier AS (SELECT demand_id, r.doc_id, quality, 1 AS pool, row_number() OVER (PARTITION BY demand_id ORDER BY d.n_chars, r.doc_id) AS pr, d.text, d.source FROM rated r JOIN documents d ON d.doc_id = r.doc_id QUALIFY pr <= 8),
u AS (SELECT * FROM best UNION ALL SELECT * FROM earlier),
f AS (SELECT *, row_number() OVER (PARTITION BY demand_id, text ORDER BY pool, pr) AS f FROM u)
SELECT demand_id, doc_id, CAST(pool AS INTEGER) AS pool, CAST(row_number() OVER (PARTITION BY demand_id ORDER BY quality DESC, pool, pr) AS INTEGER) AS rank FROM f WHERE f = 1 QUALIFY rank <= 5""")
def merge_evidence_pools(spark, d):
    rated = blended(spark, d).withColumn("blend", F.round("blend", 4))
    best = E.best_for_demands(rated, "doc_id").withColumnRenamed("rank", "pool_rank")
    earlier = R.top_k(rated, ["demand_id"], [F.length("text"), F.col("doc_id")], 8, "pool_rank")
    out = R.merge_evidence_pools([best, earlier], "demand_id", "text", "quality")
    return out.select("demand_id", "doc_id", "pool", "rank")


