"""Queries over predicates, quality rules and recency."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, quality
from ..sources.tables import COMMENTS_SQL, REVIEWS_SQL, comments, reviews, table
from . import bindings as B
from .registry import query


@query("match_any_pattern", "C1", f"SELECT doc_id, {B.sql_reject('text')} AS pattern FROM documents")
def match_any_pattern(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", quality.match_any_pattern("text", B.QUALITY.reject).alias("pattern")
    )


@query("is_incoherent", "C2", f"WITH {B.sql_quality_cte('documents', 'doc_id', 'text')} SELECT k AS doc_id, jumpy FROM quality")
def is_incoherent(spark, d):
    return table(spark, d, "documents").select("doc_id", quality.is_incoherent("text", B.QUALITY).alias("jumpy"))


@query("assess_quality", "C3", f"""
WITH {B.sql_quality_cte('documents', 'doc_id', 'text')}
SELECT k AS doc_id, score AS quality_score, reason AS quality_reason, score >= 2 AS keep FROM quality""")
def assess_quality(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return quality.assess_quality(docs, "text", B.QUALITY).drop("text")


def _sql_sample(title_terms, keywords):
    built = " OR ".join(
        "(" + " AND ".join([f"contains(x, {B.q(w)})" for w in every] + [B.sql_contains_any("x", some)]) + ")"
        for every, some in B.SAMPLE.structure
    )
    return f"""CASE WHEN length(x) < 20 OR reject IS NOT NULL OR jumpy THEN 0.0 ELSE least(greatest(5.0
      + CASE WHEN length(x) < 30 THEN -2 WHEN length(x) >= 50 THEN 1 ELSE 0 END + least(useful * 0.5, 2)
      + least(({B.sql_count_present('lower(x)', title_terms)} + {B.sql_count_present('lower(x)', keywords)}) * 0.5, 2)
      + CASE WHEN {built} THEN 1 ELSE 0 END
      - CASE WHEN {B.sql_count_present('x', B.SAMPLE.negative)} >= 3 THEN 2 ELSE 0 END
      + CASE WHEN {B.sql_contains_any('x', B.SAMPLE.scenario)} THEN 0.5 ELSE 0 END, 0), 10) END::DOUBLE"""


def sql_sample_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT k AS doc_id, {B.q(i)} AS demand_id, {_sql_sample(B.title_terms(t), kw)} AS quality FROM quality"
        for i, t, kw in B.DEMANDS
    )


@query("assess_sample_quality", "C4", f"WITH {B.sql_quality_cte('documents', 'doc_id', 'text')} {sql_sample_rows()}")
def assess_sample_quality(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", quality.passes_rules("text", B.QUALITY).alias("gate"))
    per_demand = F.array(*[
        F.struct(
            F.lit(i).alias("demand_id"),
            quality.sample_quality("text", F.col("gate"), B.title_terms(t), kw, B.QUALITY, B.SAMPLE).alias("quality"),
        )
        for i, t, kw in B.DEMANDS
    ])
    return docs.select("doc_id", F.inline(per_demand))


@query("is_low_quality_comment", "C5", f"""
WITH t AS (SELECT id, {B.sql_trim('content')} AS t FROM ({COMMENTS_SQL}))
SELECT id, length(t) < 30 OR length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g')) / greatest(length(t), 1) < 0.4
  OR list_contains({B.sql_list(B.PHRASES)}, regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}_]', '', 'g'))
  OR regexp_matches(t, '^https?://\\S+$')
  OR (length(t) < 60 AND regexp_matches(t, '\\p{{Lu}}') AND NOT regexp_matches(t, '\\p{{Ll}}'))
  OR list_bool_or([substr(t, i, 1) <> chr(10) AND substr(t, i, 7) = repeat(substr(t, i, 1), 7) for i in range(1, length(t) - 5)]) IS TRUE AS low
FROM t""")
def is_low_quality_comment(spark, d):
    return comments(spark, d).select("id", quality.is_low_quality_comment("content", B.PHRASES).alias("low"))


_EMO = "(" + " + ".join(f"len(regexp_extract_all(lower(text), {B.q(p)}))" for p in B.EMOTIONAL) + ")"
_RUDE = "|".join(f"(?:{p})" for p in B.OFFENSIVE)
SQL_CIVIL = f"(NOT regexp_matches(lower(text), '{_RUDE}') AND {_EMO} <= 2 AND NOT (length(text) < 30 AND {_EMO} > 0))"


@query("is_civil", "C6", f"SELECT doc_id, {SQL_CIVIL} AS civil FROM documents")
def is_civil(spark, d):
    return table(spark, d, "documents").select("doc_id", quality.is_civil("text", B.OFFENSIVE, B.EMOTIONAL).alias("civil"))


SQL_INFO = """(length(text) BETWEEN 30 AND 300
  AND length(regexp_replace(text, '[^\\x{4e00}-\\x{9fa5}\\p{Latin}0-9]', '', 'g')) >= 20
  AND len(list_distinct(string_split(text, ''))) >= 10)"""


@query("has_information", "C7", f"SELECT doc_id, {SQL_INFO} AS informative FROM documents")
def has_information(spark, d):
    return table(spark, d, "documents").select("doc_id", quality.has_information("text").alias("informative"))


_OCC = [B.sql_occurrences("lower(text)", k) for k in B.KEYWORDS]
SQL_STRONG = (
    f"({B.sql_count_present('lower(text)', B.KEYWORDS)} >= 2 OR ({' + '.join(_OCC)}) >= 2 "
    f"OR (length(text) >= 60 AND {B.sql_count_present('lower(text)', B.KEYWORDS)} >= 1))"
)


@query("is_strongly_relevant", "C8", f"SELECT doc_id, {SQL_STRONG} AS strong FROM documents")
def is_strongly_relevant(spark, d):
    return table(spark, d, "documents").select("doc_id", quality.is_strongly_relevant("text", B.KEYWORDS).alias("strong"))


@query("search_by_topic", "C9", f"""
SELECT id, app_name FROM ({REVIEWS_SQL})
WHERE {B.sql_contains_any('lower(content)', ['with', 'nicht', 'avec'])} AND NOT {B.sql_contains_any('lower(content)', ['idiot', 'license'])}""")
def search_by_topic(spark, d):
    r = reviews(spark, d)
    return r.filter(quality.on_topic_terms("content", ["with", "Nicht", "avec"], ["idiot", "License"])).select("id", "app_name")


@query("is_tech_issue", "C10", f"""
SELECT doc_id, {B.sql_contains_any('lower(text)', B.TECH_WORDS)}
  AND NOT regexp_matches(text, {B.q('|'.join(f'(?:{p})' for p in B.NEED_PATTERNS))}) AS tech FROM documents""")
def is_tech_issue(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", quality.is_tech_issue("text", B.TECH_WORDS, B.NEED_PATTERNS).alias("tech")
    )


@query("on_topic", "C11", f"""
SELECT id, category FROM (SELECT *, lower(story_title || ' ' || content) AS t, id % 5 = 0 AS store FROM ({COMMENTS_SQL}))
WHERE store OR (category <> 'media' AND CASE category {' '.join(f"WHEN {B.q(c)} THEN {B.sql_contains_any('t', w)}" for c, w in B.TOPICS.items())} ELSE true END)""")
def on_topic(spark, d):
    c = comments(spark, d).withColumn("source", F.when(F.col("id") % 5 == 0, "store").otherwise("forum"))
    text = F.concat_ws(" ", "story_title", "content")
    return c.filter(quality.on_topic("category", "source", text, B.TOPICS, "forum", ["media"])).select("id", "category")


@query("recent_only", "C12", f"""
WITH r AS (SELECT id, CASE WHEN doc_id % 13 = 0 THEN 'n/a' ELSE date END AS date, doc_id FROM ({REVIEWS_SQL})),
t AS (SELECT *, TRY_CAST(CASE WHEN length(date) = 10 THEN date || 'T00:00:00Z' ELSE date END AS TIMESTAMPTZ) AS ts FROM r)
SELECT id, coalesce(ts >= TIMESTAMPTZ '2024-06-30 00:00:00+00', false) AS strict,
       coalesce(ts >= TIMESTAMPTZ '2024-06-30 00:00:00+00', true) AS lenient FROM t""")
def recent_only(spark, d):
    r = reviews(spark, d).withColumn("date", F.when(F.col("doc_id") % 13 == 0, "n/a").otherwise(F.col("date")))
    return r.select(
        "id",
        dates.recent_only("date", "2024-06-30").alias("strict"),
        dates.recent_only("date", "2024-06-30", keep_unparsed=True).alias("lenient"),
    )


@query("drop_stale_evidence", "C13", f"""
WITH e AS (SELECT id, doc_id, channel AS source, 'https://forum.example.org/item?id=' || CAST(doc_id * 7 AS VARCHAR) AS source_url,
             CASE WHEN doc_id % 4 = 0 THEN '' ELSE substr(date, 1, 10) END AS date FROM ({REVIEWS_SQL})),
k AS (SELECT 'https://forum.example.org/item?id=' || CAST(doc_id * 7 AS VARCHAR) AS url, substr(date, 1, 10) AS created
      FROM ({REVIEWS_SQL}) WHERE doc_id % 2 = 0)
SELECT e.id, e.source FROM e LEFT JOIN k ON k.url = e.source_url
WHERE e.source <> 'forum' OR NOT (coalesce(k.created < '2024-05-01', false)
  OR (e.date <> '' AND e.date < '2024-05-01') OR e.doc_id * 7 < 2000)""")
def drop_stale_evidence(spark, d):
    r = reviews(spark, d)
    link = F.concat(F.lit("https://forum.example.org/item?id="), (F.col("doc_id") * 7).cast("string"))
    day = F.substring("date", 1, 10)
    ev = r.select(
        "id", F.col("channel").alias("source"), link.alias("source_url"),
        F.when(F.col("doc_id") % 4 == 0, "").otherwise(day).alias("date"),
    )
    known = r.filter("doc_id % 2 = 0").select(link.alias("url"), day.alias("created_at"))
    return quality.drop_stale_evidence(ev, known, "2024-05-01", "forum", 2000).select("id", "source")


@query("low_rating", "C14", f"""
SELECT id FROM (SELECT id, CASE WHEN channel <> 'forum' THEN rating END AS rating FROM ({REVIEWS_SQL})) WHERE rating IS NULL OR rating <= 3""")
def low_rating(spark, d):
    r = reviews(spark, d).withColumn("rating", F.when(F.col("channel") != "forum", F.col("rating")))
    return r.filter(quality.low_rating("rating")).select("id")


@query("pain_related", "C15", f"SELECT doc_id FROM documents WHERE {B.sql_contains_any('lower(text)', ['nicht', 'without', 'sans', 'idiot'])}")
def pain_related(spark, d):
    return table(spark, d, "documents").filter(
        quality.pain_related("text", ["nicht", "without", "sans", "idiot"])
    ).select("doc_id")
