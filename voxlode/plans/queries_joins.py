"""Queries over joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..sources.tables import ATOMS_SQL, COMMENTS_SQL, REVIEWS_SQL, atoms, comments, reviews, table
from .registry import query


def _dim(spark, d):
    src = table(spark, d, "documents").select("source").distinct().withColumn("n", F.substring("source", 4, 9).cast("int"))
    return src.filter("n % 2 = 0").select(
        F.col("source").alias("title"), F.concat(F.lit("voice of "), "source").alias("user_voice"),
        F.concat(F.lit("fix "), F.col("n").cast("string")).alias("solution"),
    )


@query("apply_dimension", "F1", """
WITH r AS (SELECT doc_id, source AS title, CASE WHEN doc_id % 3 = 0 THEN 'generic' ELSE 'own' END AS user_voice FROM documents),
m AS (SELECT *, CAST(substr(title, 4) AS INTEGER) AS n FROM r)
SELECT doc_id, title, CASE WHEN n % 2 = 0 AND user_voice = 'generic' THEN 'voice of ' || title ELSE user_voice END AS user_voice,
  CASE WHEN n % 2 = 0 AND user_voice = 'generic' THEN 'fix ' || n ELSE 'to do' END AS solution, n % 2 = 0 AND user_voice = 'generic' AS mapped FROM m""")
def apply_dimension(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("title"), F.when(F.col("doc_id") % 3 == 0, "generic").otherwise("own").alias("user_voice")
    )
    return J.apply_dimension(
        rows, _dim(spark, d), "title", ["user_voice", "solution"], ("user_voice", "generic"), {"solution": "to do"}
    )


@query("unmapped_titles", "F1 I3", "SELECT DISTINCT source AS title FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 2 = 1")
def unmapped_titles(spark, d):
    rows = table(spark, d, "documents").select(F.col("source").alias("title"))
    return J.unmapped(rows, _dim(spark, d), "title")


_TITLE = """CASE WHEN doc_id % 25 = 0 THEN substr(text, 3, 9) WHEN doc_id % 25 = 1 THEN replace(substr(text, 3, 9), ' ', '')
  WHEN doc_id % 25 = 2 THEN substr(text, 4, 3) ELSE substr(text, 1, 60) END"""


@query("tiered_lookup", "F2", f"""
WITH t AS (SELECT doc_id, {_TITLE} AS title FROM documents),
k AS (SELECT doc_id AS ord, substr(text, 3, 9) AS key FROM documents WHERE doc_id % 5 = 0),
u AS (SELECT DISTINCT title FROM t),
c AS (SELECT title, ord, CASE WHEN title = key THEN 1 WHEN replace(title, ' ', '') = replace(key, ' ', '') THEN 2 ELSE 3 END AS tier
      FROM u JOIN k ON title = key OR replace(title, ' ', '') = replace(key, ' ', '')
        OR (length(key) >= 4 AND length(title) > 0 AND (contains(title, key) OR contains(key, title)))),
b AS (SELECT title, tier, ord, row_number() OVER (PARTITION BY title ORDER BY tier, ord) AS r FROM c)
SELECT t.doc_id, b.tier, CASE WHEN b.ord IS NOT NULL THEN 'plan ' || b.ord END AS plan FROM t LEFT JOIN b ON b.title = t.title AND b.r = 1""")
def tiered_lookup(spark, d):
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", F.expr(_TITLE).alias("title"))
    dim = docs.filter("doc_id % 5 = 0").select(
        F.col("doc_id").alias("ord"), F.expr("substr(text, 3, 9)").alias("key"), F.concat(F.lit("plan "), F.col("doc_id").cast("string")).alias("plan")
    )
    return J.tiered_lookup(rows, dim, "title", "key", "ord", ["plan"]).select("doc_id", "tier", "plan")


_SAMPLE = """CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN replace(substr(text, 1 + length(text) // 3, 120), ' ', '  ')
  WHEN 2 THEN substr(text, 1, 90) || ' (cut)' WHEN 3 THEN 'quote: ' || substr(text, 1, 400) || ' end' ELSE md5(text) || substr(text, 60, 12) END"""
_BARE = "regexp_replace({}, '[\\s\\x{{85}}\\p{{Z}}]+', '', 'g')"


@query("match_text_rows", "F3", f"""
WITH s AS (SELECT doc_id AS sid, {_SAMPLE} AS t FROM documents), d AS (SELECT doc_id AS rid, text AS t FROM documents WHERE text <> ''),
e AS (SELECT sid, min(rid) AS rid FROM s JOIN d USING (t) GROUP BY sid),
sb AS (SELECT sid, {_BARE.format('t')} AS b FROM s WHERE sid NOT IN (SELECT sid FROM e)), db AS (SELECT rid, {_BARE.format('t')} AS b FROM d),
l AS (SELECT sid, min(rid) AS rid FROM sb JOIN db ON contains(db.b, sb.b) OR contains(sb.b, db.b)
   OR (length(sb.b) > 20 AND length(db.b) > 20 AND substr(sb.b, 1, 50) = substr(db.b, 1, 50)) WHERE length(sb.b) > 0 AND length(db.b) > 0 GROUP BY sid)
SELECT sid, rid, 'exact' AS how FROM e UNION ALL SELECT sid, rid, 'similar' AS how FROM l""")
def match_text_rows(spark, d):
    docs = table(spark, d, "documents")
    samples = docs.select(F.col("doc_id").alias("sid"), F.expr(_SAMPLE.replace("length(text) // 3", "length(text) div 3")).alias("t"))
    return J.match_text_rows(samples, docs.select(F.col("doc_id").alias("rid"), F.col("text").alias("t")), "t", "sid", "rid")


@query("join_evidence", "F4", f"""
SELECT a.atom_id, a.label AS demand_id, r.id AS source_review_id, r.rating, a.need_statement
FROM ({ATOMS_SQL}) a JOIN ({REVIEWS_SQL}) r ON r.id = a.source_review_id WHERE r.rating <= 4""")
def join_evidence(spark, d):
    a = atoms(spark, d)
    members = a.select(F.col("label").alias("demand_id"), "atom_id")
    cands = reviews(spark, d).filter("rating <= 4").select("id", "rating")
    out = J.join_evidence(members, a.select("atom_id", "source_review_id", "need_statement"), cands)
    return out.select("atom_id", "demand_id", "source_review_id", "rating", "need_statement")


_TR = "[À-ÿ]"


@query("left_join_translation", "F5", f"""
WITH t AS (SELECT conv_id * 1000 + turn - 1 AS id, text AS zh FROM conversations WHERE role = 'assistant' AND turn > 0),
u AS (SELECT * FROM t WHERE regexp_matches(zh, '{_TR}'))
SELECT c.id, md5(coalesce(u.zh, c.content)) AS content_key, u.zh IS NOT NULL AS has_translation
FROM ({COMMENTS_SQL}) c LEFT JOIN u ON u.id = c.id""")
def left_join_translation(spark, d):
    turns = table(spark, d, "conversations").filter("role = 'assistant' AND turn > 0")
    tr = turns.select((F.col("conv_id") * 1000 + F.col("turn") - 1).alias("id"), F.col("text").alias("zh"))
    j = J.left_join_translation(comments(spark, d), tr, "content", "zh", "À-ÿ")
    return j.select("id", F.md5("content_out").alias("content_key"), "has_translation")


MERGE_RULES = {
    "en": [("one group", ["src1", "source src2 of"]), ("two group", ["src3"]), ("src4", [])],
    "fr": [("deux", ["src2"])],
}


@query("resolve_merge_target", "F6", f"""
SELECT id, CASE WHEN category = 'en' AND (app_name = 'one group' OR contains(app_name, 'src1') OR contains('src1', app_name) OR contains(app_name, 'source src2 of') OR contains('source src2 of', app_name)) THEN 'one group'
  WHEN category = 'en' AND (contains(app_name, 'src3') OR contains('src3', app_name)) THEN 'two group' WHEN category = 'en' AND app_name = 'src4' THEN 'src4'
  WHEN category = 'fr' AND (contains(app_name, 'src2') OR contains('src2', app_name)) THEN 'deux' ELSE app_name END AS target FROM ({REVIEWS_SQL})""")
def resolve_merge_target(spark, d):
    return reviews(spark, d, rated=False).select("id", J.resolve_merge_target("app_name", "category", MERGE_RULES).alias("target"))


@query("resume_anti_join", "F9 I1", """
WITH done AS (SELECT doc_id FROM labels WHERE quality = 1), todo AS (SELECT doc_id FROM documents)
SELECT doc_id, 'new' AS state FROM todo WHERE doc_id NOT IN (SELECT doc_id FROM done) UNION ALL SELECT doc_id, 'done' AS state FROM done""")
def resume_anti_join(spark, d):
    done = table(spark, d, "labels").filter("quality = 1").select("doc_id")
    todo = J.resume_anti_join(table(spark, d, "documents").select("doc_id"), done, "doc_id")
    return todo.withColumn("state", F.lit("new")).unionByName(done.withColumn("state", F.lit("done")))


@query("union_sources", "I1", f"""
SELECT id, content_chars, rating, points FROM (
  SELECT id, length(content) AS content_chars, rating, NULL::INTEGER AS points FROM ({REVIEWS_SQL})
  UNION ALL SELECT 'hn_' || CAST(id AS VARCHAR), length(content), NULL::INTEGER, points FROM ({COMMENTS_SQL}))""")
def union_sources(spark, d):
    r = reviews(spark, d).select("id", F.length("content").cast("bigint").alias("content_chars"), "rating")
    c = comments(spark, d).select(
        F.concat(F.lit("hn_"), F.col("id").cast("string")).alias("id"), F.length("content").cast("bigint").alias("content_chars"), "points"
    )
    return r.unionByName(c, allowMissingColumns=True)
