"""Queries over scalar text and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..sources.tables import REVIEWS_SQL, reviews, table
from . import bindings as B
from .registry import query

_ENT = "html"
for _name, _char in text.ENTITIES.items():
    _ENT = f"replace({_ENT}, {B.q(_name)}, {B.q(_char)})"
# Named entities of the pages that the common list leaves to the full decoder.
_ENT = f"replace(replace(replace({_ENT}, '&copy;', chr(169)), '&middot;', chr(183)), '&amp', '&')"


@query("clean_html", "B1", f"""
SELECT page_id, md5({B.sql_squeeze(f"regexp_replace({_ENT}, '<[^>]+>', ' ', 'g')")}) AS plain,
       CAST(length({B.sql_squeeze(f"regexp_replace({_ENT}, '<[^>]+>', ' ', 'g')")}) AS BIGINT) AS chars
FROM pages""")
def clean_html(spark, d):
    p = table(spark, d, "pages").select("page_id", text.clean_html("html").alias("t"))
    return p.select("page_id", F.md5("t").alias("plain"), F.length("t").cast("bigint").alias("chars"))


@query("parse_ts", "B2", f"""
SELECT id, CAST(epoch(TRY_CAST(CASE WHEN length(date) = 10 THEN date || 'T00:00:00Z' ELSE date END AS TIMESTAMPTZ)) AS BIGINT) AS instant,
       substr(date, 1, 10) AS day FROM ({REVIEWS_SQL})""")
def parse_ts(spark, d):
    r = reviews(spark, d)
    return r.select("id", dates.parse_ts("date").cast("bigint").alias("instant"), dates.day_label("date").alias("day"))


_DATE_FORMS = """CASE doc_id % 5 WHEN 0 THEN substr(date, 1, 10) WHEN 1 THEN replace(substr(date, 1, 10), '-', '/')
  WHEN 2 THEN substr(date, 9, 2) || '/' || substr(date, 6, 2) || '/' || substr(date, 1, 4)
  WHEN 3 THEN 'around ' || date ELSE date END"""


@query("format_date_multi", "B3", f"""
SELECT id, CASE WHEN doc_id % 5 = 3 THEN substr('around ' || date, 1, 10) ELSE substr(date, 1, 10) END AS day
FROM ({REVIEWS_SQL})""")
def format_date_multi(spark, d):
    r = reviews(spark, d).withColumn("raw", F.expr(_DATE_FORMS))
    return r.select("id", dates.format_date_multi("raw").alias("day"))


@query("script_ratio", "B4", r"""
SELECT doc_id, round(length(regexp_replace(text, '[^\x{00C0}-\x{024F}]', '', 'g')) / greatest(length(text), 1), 6) AS accented,
       length(regexp_replace(text, '[^\x{00C0}-\x{024F}]', '', 'g')) / greatest(length(text), 1) > 0.03 AS mostly,
       regexp_matches(text, '[\x{00C0}-\x{024F}]') AS some
FROM documents""")
def script_ratio(spark, d):
    latin = r"\x{00C0}-\x{024F}"
    r = text.script_ratio("text", latin)
    return table(spark, d, "documents").select(
        "doc_id", F.round(r, 6).alias("accented"), (r > 0.03).alias("mostly"), text.has_script("text", latin).alias("some")
    )


@query("truncate_text", "B5", f"SELECT doc_id, {B.sql_truncate('text', 250)} AS shown FROM documents")
def truncate_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.truncate("text", 250).alias("shown"))


_TERMS = f"[t for t in regexp_extract_all(text, '{B.WORD}') if NOT list_contains({B.sql_list(B.STOPWORDS)}, t)]"


@query("extract_terms", "B6 I3", f"""
SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms,
       array_to_string(list_filter(terms, lambda t, i: list_position(terms, t) = i)[1:20], ' ') AS first_terms
FROM (SELECT doc_id, {_TERMS} AS terms FROM documents)""")
def extract_terms(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.size(text.extract_terms("text", B.WORD, B.STOPWORDS)).alias("n_terms"),
        F.array_join(text.extract_terms("text", B.WORD, B.STOPWORDS, distinct=True, cap=20), " ").alias("first_terms"),
    )


@query("top_terms", "B7", f"""
WITH t AS (SELECT doc_id, unnest(terms) AS term, unnest(range(len(terms))) AS pos
           FROM (SELECT doc_id, {_TERMS} AS terms FROM documents)),
     c AS (SELECT doc_id, term, count(*) AS n, min(pos) AS p FROM t GROUP BY ALL),
     k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, p) AS r FROM c)
SELECT d.doc_id, coalesce(string_agg(k.term, ' ' ORDER BY k.r), '') AS terms
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id AND k.r <= 5 GROUP BY d.doc_id""")
def top_terms(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(text.top_terms("text", B.WORD, 5, B.STOPWORDS), " ").alias("terms"))


_INTENT = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_matches(text, {B.q(p)}) THEN {B.sql_trim(f'regexp_extract(text, {B.q(p)}, {g})')} END"
    for p, g in B.INTENTS
)


@query("extract_intent", "B8", f"""
SELECT doc_id, {_INTENT}) AS intent,
       {_INTENT}, CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END) AS intent_or_start
FROM documents""")
def extract_intent(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        text.extract_intent("text", B.INTENTS).alias("intent"),
        text.extract_intent("text", B.INTENTS, 50).alias("intent_or_start"),
    )


@query("strip_symbols", "B9", f"""
SELECT doc_id, md5({B.sql_trim("regexp_replace(replace(replace(text, chr(10), ' '), chr(13), ' '), '[\\x{10000}-\\x{10FFFF}]', '', 'g')")}) AS plain
FROM documents""".replace("x10000", "x{10000}").replace("x1114111", "x{10FFFF}"))
def strip_symbols(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.strip_symbols("text")).alias("plain"))


_S = B.STATEMENT
_OP, _MO = rf"^(?:{_S.opener})\s*", rf"^(?:{_S.modal})\s*"
_TH = rf"^({_S.subject})\s*(?:{_S.subject_modal})\s*"


@query("normalize_statement", "B10", f"""
WITH s AS (SELECT doc_id, text, {B.sql_trim('text')} AS s FROM documents),
b AS (SELECT *, regexp_matches(s, '{_OP}') AS h1, regexp_matches(s, '{_MO}') AS h2, regexp_matches(s, '{_TH}') AS h3,
             trim(regexp_extract(s, '{_TH}', 1)) AS subj FROM s),
c AS (SELECT *, CASE WHEN h1 THEN regexp_replace(s, '{_OP}', '') WHEN h2 THEN regexp_replace(s, '{_MO}', '')
        WHEN h3 THEN (CASE WHEN list_contains({B.sql_list(_S.generic_subjects)}, subj) THEN '' ELSE subj || ' ' END)
                     || regexp_replace(s, '{_TH}', '') ELSE s END AS body FROM b),
t AS (SELECT *, regexp_replace({B.sql_squeeze('body')}, '^[,.:; ]+', '') AS tidy FROM c)
SELECT doc_id, CASE WHEN text = '' THEN '' WHEN h1 OR h2 OR h3 THEN 'Users suggest ' || tidy
  ELSE 'Users suggest:' || CASE WHEN tidy = '' THEN text ELSE tidy END END AS statement FROM t""")
def normalize_statement(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_statement("text", _S).alias("statement"))


@query("split_source", "B11", f"""
SELECT id, CASE WHEN doc_id % 11 = 0 THEN channel WHEN doc_id % 7 = 0 THEN channel ELSE channel END AS platform,
       CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN NULL ELSE app_name || ' - ' || category END AS label
FROM ({REVIEWS_SQL})""")
def split_source(spark, d):
    n = F.col("doc_id")
    src = (
        F.when(n % 11 == 0, F.col("channel"))
        .when(n % 7 == 0, F.concat("channel", F.lit(" - [dead]")))
        .otherwise(F.concat_ws(" - ", "channel", "app_name", "category"))
    )
    return reviews(spark, d, rated=False).select("id", text.split_source(src).alias("s")).select("id", "s.platform", "s.label")


@query("channel_of_url", "B12", "SELECT page_id, CASE " + " ".join(
    f"WHEN contains(url, {B.q(f)}) THEN {B.q(c)}" for f, c in B.URL_CHANNELS) + " ELSE 'Web' END AS channel FROM pages")
def channel_of_url(spark, d):
    return table(spark, d, "pages").select("page_id", text.channel_of_url("url", B.URL_CHANNELS, "Web").alias("channel"))


@query("source_url", "B13", f"""
SELECT id, CASE WHEN doc_id % 4 = 0 THEN 'https://given.example.org/' || id
  WHEN channel = 'store' THEN 'https://store.example.org/app/' || app_name || '?see-all=reviews'
  WHEN channel = 'forum' THEN 'https://forum.example.org/item?id=' || CAST(doc_id AS VARCHAR) ELSE '' END AS link
FROM ({REVIEWS_SQL})""")
def source_url(spark, d):
    given = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("https://given.example.org/"), F.col("id")))
    forms = [
        ("store", F.col("app_name"), "https://store.example.org/app/{}?see-all=reviews"),
        ("forum", F.col("doc_id"), "https://forum.example.org/item?id={}"),
    ]
    return reviews(spark, d, rated=False).select("id", text.source_url(given, "channel", forms).alias("link"))


@query("content_key", "B14", f"""
SELECT doc_id, substr(replace({B.sql_trim('text')}, chr(10), ' '), 1, 50) AS key FROM documents""")
def content_key(spark, d):
    return table(spark, d, "documents").select("doc_id", text.content_key("text").alias("key"))


@query("compose_text", "B15", """
SELECT doc_id, source || ' | ' || lang || ' | ' || substr(text, 1, 120) AS embed_text FROM documents""")
def compose_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", text.compose_text([("source", None), ("lang", None), ("text", 120)]).alias("embed_text")
    )


@query("map_value", "B16", f"""
SELECT id, CASE category WHEN 'en' THEN 0.9 WHEN 'fr' THEN 0.3 ELSE 0.5 END::DOUBLE AS score,
       (CASE WHEN rating <= 2 THEN 0.2 WHEN rating <= 4 THEN 0.6 ELSE 0.8 END)::DOUBLE AS bucket,
       rating / 5::DOUBLE AS share FROM ({REVIEWS_SQL})""")
def map_value(spark, d):
    return reviews(spark, d).select(
        "id",
        text.map_value("category", {"en": 0.9, "fr": 0.3}, 0.5).alias("score"),
        text.rating_bucket("rating").alias("bucket"),
        (F.col("rating") / 5).alias("share"),
    )


@query("stable_id", "B17", f"""
SELECT doc_id, 'as_' || CASE WHEN doc_id % 3 = 0 THEN substr(md5(content), 1, 8) ELSE CAST(doc_id AS VARCHAR) END AS rid
FROM ({REVIEWS_SQL})""")
def stable_id(spark, d):
    key = F.when(F.col("doc_id") % 3 != 0, F.col("doc_id"))
    return reviews(spark, d, rated=False).select("doc_id", text.stable_id("as_", key, "content").alias("rid"))


@query("term_overlap", "I2", f"""
WITH t AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '{B.WORD}') AS terms, string_split(text, chr(10))[1] AS head FROM documents),
h AS (SELECT doc_id, terms, regexp_extract_all(lower(head), '{B.WORD}') AS title FROM t)
SELECT doc_id, CAST(len(list_intersect(title, terms)) AS INTEGER) AS shared,
  round(len(list_intersect(title, terms[20:])) / greatest(len(list_distinct(title)), 1), 6) AS later_share FROM h""")
def term_overlap(spark, d):
    low = F.lower("text")
    df = table(spark, d, "documents").select(
        "doc_id",
        text.extract_terms(low, B.WORD).alias("terms"),
        text.extract_terms(F.get(F.split(low, "\n"), 0), B.WORD).alias("title"),
    )
    later = F.when(F.size("terms") >= 20, F.slice("terms", F.lit(20), F.size("terms"))).otherwise(
        F.array().cast("array<string>"))
    return df.select(
        "doc_id",
        F.size(F.array_intersect("title", "terms")).alias("shared"),
        F.round(text.term_overlap(F.col("title"), later), 6).alias("later_share"),
    )
