"""Queries over aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality
from ..functions.text import extract_intent, extract_terms
from ..operators import aggregates as A
from ..operators import tagging
from ..session import cut
from ..sources.tables import ATOMS_SQL, COMMENTS_SQL, REVIEWS_SQL, atoms, comments, reviews, table
from . import bindings as B
from .queries_scores import STATS_SQL, demand_stats
from .registry import query


def shown(c, sep=";"):
    """A value -> count map as sorted text."""
    return A.format_distribution(c, joiner=sep)


@query("distribution_map", "G1", f"""
WITH c AS (SELECT category, label, product, count(*) AS n, min(doc_id) AS f FROM ({ATOMS_SQL}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY category, label ORDER BY n DESC, f, product) AS r FROM c)
SELECT category, label, string_agg(product || '(' || n || ')', ';' ORDER BY n DESC, product) AS products FROM r WHERE r <= 10 GROUP BY category, label""")
def distribution_map(spark, d):
    m = A.distribution_map(atoms(spark, d), ["category", "label"], "product", 10, F.col("doc_id"))
    return m.select("category", "label", shown("dist").alias("products"))


@query("distribution_long_star", "G1", """
SELECT o_orderpriority, p_brand, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
GROUP BY o_orderpriority, p_brand""")
def distribution_long_star(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return A.distribution(li.join(part, "l_partkey").join(orders, "l_orderkey"), ["o_orderpriority"], "p_brand").select(
        "o_orderpriority", "p_brand", "n"
    )


@query("merge_maps", "G2", f"""
WITH c AS (SELECT category, label, product, count(*) AS n, min(doc_id) AS f FROM ({ATOMS_SQL}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY category, label ORDER BY n DESC, f, product) AS r FROM c),
s AS (SELECT label % 3 AS grp, product, sum(n) AS n FROM r WHERE r <= 10 GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, product) AS k FROM s)
SELECT CAST(grp AS INTEGER) AS grp, string_agg(product || '(' || CAST(n AS BIGINT) || ')', ';' ORDER BY n DESC, product) AS products FROM t WHERE k <= 12 GROUP BY grp""")
def merge_maps(spark, d):
    m = A.distribution_map(atoms(spark, d), ["category", "label"], "product", 10, F.col("doc_id"))
    m = m.withColumn("grp", (F.col("label") % 3).cast("int"))
    return A.merge_maps(m, ["grp"], "dist", 12).select("grp", shown("dist").alias("products"))


@query("weighted_avg", "G3", """
SELECT p_brand, round(sum(l_quantity * l_discount) / greatest(sum(l_quantity), 1), 6)::DOUBLE AS mean_discount
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand""")
def weighted_avg(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    li = table(spark, d, "lineitem").select("l_partkey", "l_quantity", "l_discount").join(part, "l_partkey")
    return li.groupBy("p_brand").agg(F.round(A.weighted_avg("l_discount", "l_quantity"), 6).alias("mean_discount"))


@query("consolidate_attrs", "G4", f"""
WITH m AS (SELECT *, label % 3 AS grp, ['feature', 'problem', 'policy'][label % 2 + 1] AS kind,
             row_number() OVER (ORDER BY category, label) AS ord FROM ({STATS_SQL})),
k AS (SELECT grp, kind, row_number() OVER (PARTITION BY grp ORDER BY sum(size) DESC, min(ord)) AS r FROM m GROUP BY grp, kind)
SELECT CAST(m.grp AS INTEGER) AS grp, CAST(count(*) AS BIGINT) AS members, CAST(sum(size) AS BIGINT) AS size,
  round(sum(round(avg_weight, 4) * size) / sum(size), 2)::DOUBLE AS avg_weight,
  CAST(min(tier) AS INTEGER) AS tier, CAST(max(ai) AS INTEGER) AS ai, CAST(round_even(avg(ai), 0) AS INTEGER) AS mean_score,
  arg_max(category || label, size * 100000 - ord) AS title, max(k.kind) AS kind
FROM m JOIN k ON k.grp = m.grp AND k.r = 1 GROUP BY m.grp""")
def consolidate_attrs(spark, d):
    s = demand_stats(spark, d)
    order = F.element_at(F.create_map(*[F.lit(x) for kv in zip(["de", "en", "es", "fr"], range(4)) for x in kv]), F.col("category"))
    m = s.select(
        (F.col("label") % 3).cast("int").alias("grp"), "size", F.round("avg_weight", 4).alias("avg_weight"), "tier", "ai",
        F.element_at(F.array(*[F.lit(x) for x in ["feature", "problem", "policy"]]), F.col("label") % 2 + 1).alias("kind"),
        (order * 100 + F.col("label")).alias("ord"), F.concat("category", F.col("label").cast("string")).alias("title"),
    )
    return A.consolidate_attrs(
        m, ["grp"], "ord", ["title"], size="size", weight="avg_weight", kind="kind", tier="tier", score="ai"
    )


@query("quality_funnel", "G5", f"""
WITH {B.sql_quality_cte(f'({REVIEWS_SQL})', 'id', 'content')},
r AS (SELECT app_name, date >= '2024-04-01' AS recent, q.score >= 2 AS good FROM ({REVIEWS_SQL}) v JOIN quality q ON q.k = v.id),
c AS (SELECT app_name, count(*) AS a, count_if(recent) AS b, count_if(recent AND good) AS g FROM r GROUP BY app_name),
u AS (SELECT app_name, unnest([0, 1, 2]) AS ord, unnest(['raw', 'recent', 'candidate']) AS stage, unnest([a, b, g]) AS n, a FROM c)
SELECT app_name, stage, CAST(n AS BIGINT) AS n, round(n / greatest(a, 1) * 100, 4)::DOUBLE AS retention_pct FROM u""")
def quality_funnel(spark, d):
    r = quality.assess_quality(reviews(spark, d, rated=False).select("app_name", "date", "content"), "content", B.QUALITY)
    stages = {"raw": F.lit(True), "recent": F.substring("date", 1, 10) >= "2024-04-01", "candidate": F.col("keep")}
    return A.funnel(r, stages, ["app_name"]).select("app_name", "stage", "n", F.round("retention_pct", 4).alias("retention_pct"))


@query("rejection_reasons", "G5", f"""
WITH {B.sql_quality_cte(f'({REVIEWS_SQL})', 'id', 'content')},
c AS (SELECT v.category, split_part(q.reason, ':', 1) AS reason, count(*) AS n FROM quality q JOIN ({REVIEWS_SQL}) v ON v.id = q.k
      WHERE q.score < 2 GROUP BY ALL)
SELECT category, reason, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (PARTITION BY category ORDER BY n DESC, reason) AS INTEGER) AS rank
FROM c QUALIFY rank <= 5""")
def rejection_reasons(spark, d):
    r = quality.assess_quality(reviews(spark, d, rated=False).select("category", "content"), "content", B.QUALITY)
    return A.top_reasons(r.filter(~F.col("keep")), F.col("quality_reason"), ["category"])


@query("group_stats", "G6", f"""
WITH r AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE rating END AS stars FROM ({REVIEWS_SQL}))
SELECT category, author, CAST(count(*) AS BIGINT) AS mentions, round(avg(CASE WHEN stars > 0 THEN stars END), 4)::DOUBLE AS avg_rating,
  round(avg(CASE WHEN stars <= 2 THEN 1.0 ELSE 0 END), 4)::DOUBLE AS low_share,
  CAST(count(DISTINCT app_name) AS BIGINT) AS apps, CAST(count(DISTINCT channel) AS BIGINT) AS sources
FROM r GROUP BY category, author HAVING count(*) >= 3""")
def group_stats(spark, d):
    r = reviews(spark, d).withColumn("stars", F.when(F.col("doc_id") % 7 == 0, 0).otherwise(F.col("rating")))
    g = A.group_stats(r, ["category", "author"], "stars", "app_name", "channel", 3)
    return g.withColumns({"avg_rating": F.round("avg_rating", 4), "low_share": F.round("low_share", 4)})


_LABELLED = "SELECT category, label FROM (" + B.sql_rule_rows(lambda r, i: (
    f"SELECT category, {B.q(r.label)} AS label FROM ({COMMENTS_SQL}) WHERE {B.sql_match('content', r)}")) + ")"


@query("totals_and_share", "G7", f"""
WITH l AS ({_LABELLED})
SELECT category, label, CAST(count(*) AS BIGINT) AS n, CAST(grouping_id(category, label) AS BIGINT) AS level,
  round(count(*) * 100.0 / (SELECT count(*) FROM l), 4)::DOUBLE AS share_pct FROM l GROUP BY ROLLUP (category, label)""")
def totals_and_share(spark, d):
    m = tagging.match_rules(comments(spark, d).select("category", "content"), "content", B.RULES)
    names = {r.rule_id: r.label for r in B.RULES}
    label = F.coalesce(*[F.when(F.col("rule_id") == k, v) for k, v in names.items()])
    out = A.totals_and_share(m.withColumn("label", label), "category", "label")
    return out.withColumn("share_pct", F.round("share_pct", 4)).withColumn("level", F.col("level").cast("bigint"))


@query("totals_and_share_star", "G7", """
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS level,
  round(count(*) * 100.0 / (SELECT count(*) FROM lineitem), 4)::DOUBLE AS share_pct
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def totals_and_share_star(spark, d):
    out = A.totals_and_share(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")
    return out.withColumn("share_pct", F.round("share_pct", 4)).withColumn("level", F.col("level").cast("bigint"))


@query("distinct_union", "G8", f"""
WITH t AS (SELECT DISTINCT lang, unnest(regexp_extract_all(text, '{B.WORD}')) AS w FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY w) AS r FROM t)
SELECT lang, string_agg(w, ' ' ORDER BY w) AS items FROM r WHERE r <= 50 GROUP BY lang""")
def distinct_union(spark, d):
    docs = table(spark, d, "documents").select("lang", "text")
    u = A.distinct_union(docs, ["lang"], extract_terms("text", B.WORD), 50)
    return u.select("lang", F.array_join("items", " ").alias("items"))


_INT = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches(content, {B.q(p)}) THEN {B.sql_trim(f'regexp_extract(content, {B.q(p)}, {g})')} END"
    for p, g in B.INTENTS) + ")"


@query("mode_value", "G9", f"""
WITH i AS (SELECT app_name, doc_id, {_INT} AS intent FROM ({REVIEWS_SQL})),
c AS (SELECT app_name, intent, count(*) AS n, min(doc_id) AS f FROM i WHERE intent IS NOT NULL GROUP BY ALL)
SELECT app_name, CAST(n AS BIGINT) AS n, CASE WHEN length(h) > 20 THEN substr(h, 1, 20) || '...' ELSE h END AS title
FROM (SELECT *, regexp_replace(intent, '(?s)[，。！？,.!?].*', '') AS h,
      row_number() OVER (PARTITION BY app_name ORDER BY n DESC, f, intent) AS r FROM c) WHERE r = 1""")
def mode_value(spark, d):
    r = reviews(spark, d, rated=False).select("app_name", "doc_id", extract_intent("content", B.INTENTS).alias("intent"))
    m = A.mode_value(r, ["app_name"], "intent", "doc_id")
    return m.select("app_name", "n", A.title_from("intent").alias("title"))


@query("value_counts", "G10", f"""
SELECT dimension, value, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(['sentiment', 'type', 'perspective', 'source']) AS dimension, unnest([sentiment, type, perspective, source]) AS value
  FROM ({ATOMS_SQL})) GROUP BY dimension, value""")
def value_counts(spark, d):
    return A.value_counts(atoms(spark, d), ["sentiment", "type", "perspective", "source"])


@query("top_stories", "G10", f"""
SELECT story_title, CAST(count(*) AS BIGINT) AS n FROM ({COMMENTS_SQL}) WHERE story_title <> '' GROUP BY story_title ORDER BY n DESC, story_title LIMIT 10""")
def top_stories(spark, d):
    return A.top_values(comments(spark, d), "story_title", 10)


@query("token_cost", "G11", """
WITH t AS (SELECT length(text) // 4 AS p, CASE WHEN turn % 3 = 0 THEN NULL ELSE length(text) // 9 END AS c, length(text) % 4 AS r FROM conversations)
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(p) AS BIGINT) AS prompt_tokens, CAST(sum(c) AS BIGINT) AS completion_tokens,
  round_even(sum(p) / 1e6 * 1 + sum(c) / 1e6 * 2, 4)::DOUBLE AS cost, CAST(count_if(r = 0) AS BIGINT) AS empty_or_failed,
  round_even(sum(r) / count(*), 2)::DOUBLE AS avg_results FROM t""")
def token_cost(spark, d):
    n = F.length("text")
    t = table(spark, d, "conversations").select(
        F.floor(n / 4).alias("p"), F.when(F.col("turn") % 3 != 0, F.floor(n / 9)).alias("c"), (n % 4).alias("r")
    )
    return A.token_cost(t, "p", "c", "r")


@query("match_rate", "G12", f"""
SELECT CAST(count_if(quality IS NOT NULL) AS BIGINT) AS matched, CAST(count(*) AS BIGINT) AS total,
  round(count_if(quality IS NOT NULL) / count(*), 6)::DOUBLE AS rate, CAST(count(DISTINCT CASE WHEN quality IS NOT NULL THEN source END) AS BIGINT) AS groups_touched
FROM documents LEFT JOIN labels USING (doc_id)""")
def match_rate(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    j = table(spark, d, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return A.match_rate(j, F.col("quality").isNotNull(), "source").withColumn("rate", F.round("rate", 6))


@query("coverage_by_product", "G13", f"SELECT category, app_name, CAST(count(*) AS BIGINT) AS n FROM ({REVIEWS_SQL}) GROUP BY category, app_name")
def coverage_by_product(spark, d):
    return A.coverage_by_product(reviews(spark, d), "category", "app_name")


@query("format_distribution", "G14", f"""
WITH c AS (SELECT category, CASE channel WHEN 'store' THEN 'Store' ELSE channel END AS name, channel, count(*) AS n FROM ({REVIEWS_SQL}) GROUP BY ALL)
SELECT category, string_agg(name || '(' || n || ')', ', ' ORDER BY n DESC, channel) AS sources FROM c GROUP BY category""")
def format_distribution(spark, d):
    m = A.distribution_map(reviews(spark, d), ["category"], "channel", 10)
    return m.select("category", A.format_distribution("dist", {"store": "Store"}).alias("sources"))


@query("matched_group", "G15", f"""
WITH h AS ({B.sql_rule_rows(lambda r, i: (
    f"SELECT id, app_name, {B.q(r.rule_id)} AS rule_id, {B.sql_count_present('content', r.keywords)} AS hits FROM ({REVIEWS_SQL}) "
    f"WHERE rating <= 3 AND {B.sql_contains_any('content', r.keywords)}"))}),
k AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY hits DESC, id) AS r, count(*) OVER (PARTITION BY rule_id) AS matched FROM h)
SELECT rule_id, CAST(max(matched) AS BIGINT) AS matched, string_agg(id, ' ' ORDER BY r) AS top_rows, array_to_string(list_sort(list_distinct(list(app_name))), ' ') AS apps
FROM k WHERE r <= 5 AND matched >= 2 GROUP BY rule_id""")
def matched_group(spark, d):
    h = tagging.keyword_hits(reviews(spark, d).select("id", "app_name", "rating", "content"), "content", "rating", B.RULES)
    # The hits are narrow and used twice: stored, so the texts are read once.
    g = A.matched_group(cut(h.drop("content", "rating")), "rule_id", "hits", "id", "app_name")
    return g.select("rule_id", "matched", F.array_join("top_rows", " ").alias("top_rows"), F.array_join("apps", " ").alias("apps"))
