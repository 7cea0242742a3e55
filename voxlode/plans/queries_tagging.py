"""Queries that tag and classify texts with lexicons."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text
from ..lexicon import rules_from_table
from ..operators import tagging
from ..sources.tables import COMMENTS_SQL, REVIEWS_SQL, comments, reviews, table
from . import bindings as B
from .registry import query


@query("tag_first", "D1", "SELECT id, CASE " + " ".join(
    f"WHEN {B.sql_contains_any('t', r.keywords)} THEN {B.q(r.label)}" for r in B.RULES
) + " END AS label, CASE " + " ".join(
    f"WHEN category = {B.q(r.category)} AND {B.sql_contains_any('t', r.keywords)} THEN {B.q(r.label)}" for r in B.RULES
) + f" END AS own_label FROM (SELECT *, lower(app_name || ' ' || content) AS t FROM ({REVIEWS_SQL}))")
def tag_first(spark, d):
    r = reviews(spark, d).withColumn("t", F.concat_ws(" ", "app_name", "content"))
    return r.select(
        "id", tagging.tag_first("t", B.RULES).alias("label"), tagging.tag_first("t", B.RULES, "category").alias("own_label")
    )


@query("tag_all", "D2", B.sql_rule_rows(lambda r, i: (
    f"SELECT doc_id, {B.q(r.label)} AS label FROM documents WHERE regexp_matches(text, {B.q('|'.join(f'(?:{p})' for p in r.patterns))})")))
def tag_all(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(tagging.tag_all("text", B.RULES)).alias("label"))


def _sql_match(r, i):
    return (
        f"SELECT doc_id, {B.q(r.rule_id)} AS rule_id, {i} AS rule_ord, {B.sql_count_present('text', r.relevance)} AS relevance "
        f"FROM documents WHERE {B.sql_match('text', r)}"
    )


@query("match_rules", "D3", B.sql_rule_rows(_sql_match))
def match_rules(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tagging.match_rules(docs, "text", B.RULES, carry=["doc_id"])


_HITS = ", ".join(
    f"{{'neg': -{B.sql_count_present('lower(text)', r.keywords)}, 'ord': {i}, 'label': {B.q(r.label)}}}"
    for i, r in enumerate(B.RULES)
)


@query("tag_best", "D4", f"""
SELECT doc_id, best.label AS label, CAST(-best.neg AS INTEGER) AS hits
FROM (SELECT doc_id, list_min([x for x in [{_HITS}] if x.neg < 0]) AS best FROM documents)""")
def tag_best(spark, d):
    return tagging.best_rules(table(spark, d, "documents").select("doc_id", "text"), "text", B.RULES).drop("text")


def _sql_score(r, i):
    pats = " + ".join(f"CASE WHEN regexp_matches(t, {B.q(p)}) THEN 2 ELSE 0 END" for p in r.patterns)
    return (f"SELECT id, category, t, {B.q(r.label)} AS label, {B.sql_count_present('t', r.keywords)} + {pats} AS score "
            f"FROM (SELECT *, lower(content) AS t FROM ({COMMENTS_SQL}))")


@query("score_rules", "D5", f"""
WITH s AS ({B.sql_rule_rows(_sql_score)})
SELECT category, label, CAST(sum(score) AS BIGINT) AS total, CAST(count_if(score >= 2) AS BIGINT) AS strong,
       min(id) FILTER (WHERE score >= 2) AS first_example
FROM s WHERE score > 0 GROUP BY category, label""")
def score_rules(spark, d):
    s = tagging.score_rules(comments(spark, d).select("id", "category", "content"), "content", B.RULES)
    strong = F.col("score") >= 2
    return s.groupBy("category", "label").agg(
        F.sum("score").cast("bigint").alias("total"),
        F.count_if(strong).alias("strong"),
        F.min(F.when(strong, F.col("id"))).alias("first_example"),
    )


@query("lexicon_sentiment", "D6", f"""
SELECT doc_id, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS sentiment
FROM (SELECT doc_id, {B.sql_count_present('lower(text)', B.POSITIVE)} AS p, {B.sql_count_present('lower(text)', B.NEGATIVE)} AS n FROM documents)""")
def lexicon_sentiment(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", tagging.lexicon_sentiment("text", B.POSITIVE, B.NEGATIVE).alias("sentiment")
    )


@query("relevance_score", "D7", f"SELECT doc_id, rule_id, round(relevance_score, 4) AS relevance_score FROM ({B.RULE_RELEVANCE_SQL}) WHERE relevance_score >= 3")
def relevance_score(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = tagging.relevant_rules(docs, "text", B.RULES, B.RELEVANCE)
    return out.select("doc_id", "rule_id", F.round("relevance_score", 4).alias("relevance_score"))


@query("keyword_hits", "D8", B.sql_rule_rows(lambda r, i: (
    f"SELECT id, {B.q(r.rule_id)} AS rule_id, {B.sql_count_present('content', r.keywords)} AS hits FROM ({REVIEWS_SQL}) "
    f"WHERE rating <= 3 AND {B.sql_contains_any('content', r.keywords)}")))
def keyword_hits(spark, d):
    return tagging.keyword_hits(reviews(spark, d).select("id", "rating", "content"), "content", "rating", B.RULES).select(
        "id", "rule_id", "hits"
    )


_EXP, _FEA, _PRO = ["smooth", "thing"], ["with ", "pour"], ["idiot", "nicht"]


@query("demand_tier", "D9", f"""
SELECT id, CASE WHEN {B.sql_contains_any('story_title', _EXP)} THEN 3
  WHEN {B.sql_contains_any('story_title', _FEA + _PRO)} THEN 1 ELSE 2 END AS tier FROM ({COMMENTS_SQL})""")
def demand_tier(spark, d):
    return comments(spark, d).select("id", tagging.demand_tier("story_title", _EXP, _FEA, _PRO).alias("tier"))


_PREFIX = {"speed": "heavy", "login": "heavy"}


@query("intervention_type", "D10", f"""
SELECT doc_id, rule_id, CASE WHEN starts_with(rule_id, 'speed_') OR starts_with(rule_id, 'login_') THEN 'heavy' ELSE 'light' END AS by_prefix,
  CASE WHEN relevance >= 2 THEN 'heavy' ELSE 'light' END AS by_score,
  CASE WHEN relevance >= 2 THEN 'heavy' ELSE 'light' END AS by_priority
FROM ({B.sql_rule_rows(_sql_match)})""")
def intervention_type(spark, d):
    m = tagging.match_rules(table(spark, d, "documents").select("doc_id", "text"), "text", B.RULES)
    high = F.when(F.col("relevance") >= 2, "P1").otherwise("P2")
    return m.select(
        "doc_id", "rule_id",
        tagging.intervention_type("prefix", "rule_id", "heavy", "light", _PREFIX).alias("by_prefix"),
        tagging.intervention_type("score", F.col("relevance") * 7 / 2, "heavy", "light").alias("by_score"),
        tagging.intervention_type("priority", high, "heavy", "light").alias("by_priority"),
    )


@query("summarize_by_scene", "D11", f"""
WITH g AS (SELECT app_name, id, content, row_number() OVER (PARTITION BY app_name ORDER BY rating, id) AS r FROM ({REVIEWS_SQL})),
t AS (SELECT app_name, string_agg(content, ' ' ORDER BY r) AS a FROM g WHERE r <= 5 GROUP BY app_name)
SELECT app_name, CASE WHEN contains(a, 'idiot') THEN 'Users want ' || app_name || ' because people are rude'
  WHEN contains(a, 'licen') THEN 'Users want ' || app_name || ' because the ' || CASE WHEN contains(a, 'MIT') THEN 'short ' ELSE '' END || 'licence is unclear'
  WHEN (contains(a, 'was ') OR contains(a, 'est ')) AND (contains(a, 'with') OR contains(a, 'avec')) THEN 'Users want ' || app_name || ' because it used to work'
  WHEN contains(a, 'nicht') THEN 'Users want ' || app_name || ' because it does not work'
  ELSE 'Users hope for ' || app_name END AS user_voice FROM t""")
def summarize_by_scene(spark, d):
    r = reviews(spark, d)
    demands = r.select("app_name").distinct().withColumn("title", F.concat(F.lit("wish "), "app_name"))
    out = tagging.summarize_by_scene(
        demands, r.select("app_name", "rating", "id", "content"), "app_name", "title", "content",
        [F.col("rating"), F.col("id")], B.SCENES, wish_words=["wish"],
    )
    return out.select("app_name", "user_voice")


_WORDS3 = f"list_filter(w, lambda t, i: list_position(w, t) = i)[1:3]"


@query("explain_keywords", "D12", f"""
WITH k AS (SELECT doc_id, doc_id % 6 AS score, list_filter(w, lambda t, i: list_position(w, t) = i) AS kw FROM (
    SELECT doc_id, regexp_extract_all(text, '(?:with|from|nicht|mit|que|para|pour|dans)') AS w FROM documents)),
e AS (SELECT doc_id, score, kw, [x for x in [CASE t WHEN 'with' THEN 'combine the parts' WHEN 'nicht' THEN 'find what is missing' WHEN 'que' THEN 'ask back'
    ELSE CASE WHEN contains(t, 'fr') THEN 'start from ' || t WHEN contains(t, 'pa') OR contains(t, 'mi') THEN 'improve ' || t END END for t in kw[1:3]] if x IS NOT NULL][1:2] AS said FROM k)
SELECT doc_id, CASE WHEN len(kw) = 0 OR score <= 2 THEN 'little room' WHEN len(said) > 0 THEN array_to_string(said, '; ')
  ELSE 'try ' || array_to_string(kw[1:2], ', ') END AS explanation FROM e""")
def explain_keywords(spark, d):
    words = text.extract_terms("text", "with|from|nicht|mit|que|para|pour|dans", distinct=True)
    t = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 6).alias("score"), words.alias("kw"))
    said = tagging.explain_keywords("kw", "score", B.EXPLAIN, B.EXPLAIN_FALLBACK, "little room", "try {kws}")
    return t.select("doc_id", said.alias("explanation"))


@query("key_phrases", "D13", "WITH p AS (" + " UNION ALL ".join(
    f"SELECT unnest(list_transform(range(1, len(regexp_extract_all(content, {B.q('(?i)' + p)})) + 1), lambda i: "
    f"regexp_extract_all(content, {B.q('(?i)' + p)}, 1)[i] || ' ' || regexp_extract_all(content, {B.q('(?i)' + p)}, 2)[i])) AS phrase FROM ({COMMENTS_SQL})"
    for p, _ in B.PHRASE_PATTERNS
) + ") SELECT phrase, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY phrase ORDER BY n DESC, phrase LIMIT 20")
def key_phrases(spark, d):
    return tagging.key_phrases(comments(spark, d), "content", B.PHRASE_PATTERNS)


def _lexicon(spark, d):
    """Rules of ten words each, from the words of the benchmark table."""
    words = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).filter("length(term) >= 4").distinct()
    place = F.row_number().over(W.orderBy("term")) - 1
    return words.withColumn("n", place).select(
        F.concat(F.lit("w"), F.floor(F.col("n") / 10).cast("string")).alias("rule_id"), F.floor(F.col("n") / 10).cast("int").alias("ord"), F.lit("").alias("label"), F.lit("").alias("category"),
        F.when(F.col("n") % 10 == 9, "exclude").when(F.col("n") % 10 >= 7, "relevance").otherwise("keyword").alias("kind"), "term",
    )


@query("match_lexicon", "D3", """
WITH t AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS n FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM benchmark) WHERE length(term) >= 4),
h AS (SELECT doc_id, n // 10 AS ord, count(*) FILTER (n % 10 < 7) AS k, count(*) FILTER (n % 10 IN (7, 8)) AS r, count(*) FILTER (n % 10 = 9) AS x
  FROM documents JOIN t ON contains(text, term) GROUP BY ALL)
SELECT doc_id, 'w' || ord AS rule_id, CAST(ord AS INTEGER) AS rule_ord, CAST(r AS INTEGER) AS relevance FROM h WHERE k > 0 AND x = 0""")
def match_lexicon(spark, d):
    """A lexicon that is a table, however many rules it has."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tagging.match_rules(docs, "text", rules_from_table(_lexicon(spark, d)), carry=["doc_id"])
