"""Queries over enrichment jobs; model replies come from the deterministic clients or are derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, quality
from ..operators import enrich as N
from ..session import scratch_path
from ..sources.tables import ATOMS_SQL, COMMENTS_SQL, REVIEWS_SQL, atoms, comments, reviews, table
from . import bindings as B
from . import queries_quality  # noqa: F401 - its SQL is reused
from .registry import REGISTRY, query

TEMPLATE = "source {source} product {product} ({perspective}, {weight})\nTEXT:{content}"


def _candidates(spark, d):
    return reviews(spark, d).select(
        "id", F.col("channel").alias("source"), F.when(F.col("channel") == "forum", "").otherwise(F.col("app_name")).alias("app_name"),
        F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("story "), F.col("category"))).alias("story_title"),
        F.col("rating").alias("weight_signal"), "content",
    )


@query("render_prompt", "J1", f"""
SELECT id, md5('source ' || channel || ' product ' || CASE WHEN channel <> 'forum' THEN app_name WHEN doc_id % 5 <> 0 THEN 'story ' || category ELSE 'unknown' END
  || ' (' || CASE WHEN channel = 'forum' THEN 'tech' ELSE 'consumer' END || ', ' || rating || ')' || chr(10) || 'TEXT:' || substr(content, 1, 1500)) AS prompt FROM ({REVIEWS_SQL})""")
def render_prompt(spark, d):
    return _candidates(spark, d).select("id", F.md5(N.atom_prompt(TEMPLATE, "forum")).alias("prompt"))


@query("cluster_prompt", "J1", f"""
WITH s AS (SELECT label, need_statement, row_number() OVER (PARTITION BY label ORDER BY weight_signal DESC, atom_id) AS r FROM ({ATOMS_SQL}) QUALIFY r <= 8)
SELECT label, md5(string_agg(r || '. ' || need_statement, chr(10) ORDER BY r)) AS statements FROM s GROUP BY label""")
def cluster_prompt(spark, d):
    s = N.numbered_statements(atoms(spark, d), ["label"], "need_statement", "weight_signal", "atom_id")
    return s.select("label", F.md5("statements").alias("statements"))


_PROMPT_SQL = """'source ' || channel || ' product ' || CASE WHEN channel <> 'forum' THEN app_name WHEN doc_id % 5 <> 0 THEN 'story ' || category ELSE 'unknown' END
  || ' (' || CASE WHEN channel = 'forum' THEN 'tech' ELSE 'consumer' END || ', ' || rating || ')' || chr(10) || 'TEXT:' || substr(content, 1, 1500)"""


@query("infer_batches", "J2 F9", f"SELECT id, CAST(length({_PROMPT_SQL}) // 4 AS BIGINT) AS prompt_tokens, true AS answered FROM ({REVIEWS_SQL})")
def infer_batches(spark, d):
    p = _candidates(spark, d).select("id", N.atom_prompt(TEMPLATE, "forum").alias("prompt"))
    path = scratch_path(spark, "replies")
    N.infer_batches(p.filter("substr(id, -1, 1) in ('1', '3')"), "id", "prompt", B.RuleClient, 4, path)
    # The second run asks only for what the first left open.
    return N.resume_infer(p, "id", "prompt", B.RuleClient, 4, path).select("id", "prompt_tokens", F.col("reply").isNotNull().alias("answered"))


_REPLY = """CASE doc_id % 6
  WHEN 0 THEN '{"atoms":[{"need_statement":" need ' || doc_id || ' ","product":"own","sentiment":"angry","feature":" f "},{"feature":"x"},{"need_statement":"second ' || doc_id || '","type":"policy"}]}'
  WHEN 1 THEN '{"atoms":[{"need_statement":"cut off'
  WHEN 2 THEN '["not", "an object"]' WHEN 3 THEN '{"atoms":[]}' WHEN 4 THEN '{"atoms":["text",{"need_statement":"third"}]}' END"""


@query("parse_atoms", "J3", """
SELECT 'doc_' || doc_id || '_a1' AS atom_id, 'need ' || doc_id AS need_statement, 'own' AS atom_product, 'f' AS feature, 'angry' AS sentiment, 'problem' AS type FROM documents WHERE doc_id % 6 = 0
UNION ALL SELECT 'doc_' || doc_id || '_a3', 'second ' || doc_id, source, '', 'neutral', 'policy' FROM documents WHERE doc_id % 6 = 0
UNION ALL SELECT 'doc_' || doc_id || '_a2', 'third', source, '', 'neutral', 'problem' FROM documents WHERE doc_id % 6 = 4""")
def parse_atoms(spark, d):
    r = table(spark, d, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"), "source", F.expr(_REPLY).alias("reply"))
    return N.parse_atoms(r, "id", "reply", "source").select("atom_id", "need_statement", "atom_product", "feature", "sentiment", "type")


_LABEL = """CASE doc_id % 4 WHEN 0 THEN '{"title":"T' || doc_id || '","demand_tier":2,"ai_score":7,"ai_keywords":["a","b"],"is_meaningful":false}'
  WHEN 1 THEN '{"title":""}' WHEN 2 THEN '{"title":"U","ai_score":3}' ELSE 'sorry' END"""


@query("parse_labels", "J4", """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'T' || doc_id ELSE 'U' END AS title, CASE WHEN doc_id % 4 = 0 THEN 7 ELSE 3 END AS ai_score,
  CASE WHEN doc_id % 4 = 0 THEN 'a,b' END AS keywords FROM documents WHERE doc_id % 4 IN (0, 2)""")
def parse_labels(spark, d):
    r = table(spark, d, "documents").select("doc_id", F.expr(_LABEL).alias("reply"))
    out = N.parse_labels(r, "reply")
    return out.select("doc_id", "title", "ai_score", F.when(F.col("ai_keywords").isNotNull(), F.array_join("ai_keywords", ",")).alias("keywords"))


@query("strip_fences", "J5", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 2 THEN 'no JSON object' END AS error FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '{}' ELSE props END AS props FROM events)""")
def strip_fences(spark, d):
    e = table(spark, d, "events")
    reply = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\ndone"))).when(
        F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.substring("props", 1, 4))
    return e.select("event_id", N.parsed_or_error(reply, "k bigint").alias("p")).select("event_id", "p.value.k", "p.error")


_J6_GROUPS = "WITH g AS (SELECT doc_id, doc_id // 4 AS grp, doc_id % 4 AS loc, source, n_chars FROM documents)"


def _merge_rounds(spark, d):
    """Groups of four documents, and a decision for four groups of five."""
    g = table(spark, d, "documents").select(
        "doc_id", F.floor(F.col("doc_id") / 4).alias("grp"), (F.col("doc_id") % 4).cast("int").alias("loc"))
    one = "array<struct<merged_title:string,merged_score:bigint,cluster_indices:array<int>>>"
    dec = g.select("grp").distinct().filter("grp % 5 <> 2").select(
        "grp", (F.col("grp") % 5 != 1).alias("should_merge"),
        F.when(F.col("grp") % 5 == 0, F.expr("array(named_struct('merged_title', concat('M', grp), 'merged_score', 7L, 'cluster_indices', array(1, 0, 1)), named_struct('merged_title', concat('N', grp), 'merged_score', CAST(NULL AS BIGINT), 'cluster_indices', array(2, 1)))"))
        .when(F.col("grp") % 5 == 3, F.expr("array(named_struct('merged_title', 'X', 'merged_score', 1L, 'cluster_indices', array(9)))"))
        .otherwise(F.array().cast(one)).cast(one).alias("merge_groups"),
        F.when(F.col("grp") % 5 == 0, F.array(F.lit(3))).otherwise(F.array(F.lit(1))).alias("exclude_indices"),
    )
    return N.apply_merge_decisions(g, dec, "grp", "doc_id", "loc")


@query("apply_merge_decisions", "J6", f"""
{_J6_GROUPS}
SELECT grp || '/0' AS out_id, 'merged' AS kind, doc_id, 'M' || grp AS merged_title, CAST(CASE WHEN loc = 1 THEN 2 ELSE 1 END AS BIGINT) AS times FROM g WHERE grp % 5 = 0 AND loc IN (0, 1)
UNION ALL SELECT grp || '/1', 'merged', doc_id, 'N' || grp, CAST(CASE WHEN loc = 1 THEN 2 ELSE 1 END AS BIGINT) FROM g WHERE grp % 5 = 0 AND loc IN (1, 2)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'excluded', doc_id, NULL, 1 FROM g WHERE grp % 5 = 0 AND loc = 3
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'kept', doc_id, NULL, 1 FROM g WHERE grp % 5 = 1
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'undecided', doc_id, NULL, 1 FROM g WHERE grp % 5 = 2
UNION ALL SELECT CAST(doc_id AS VARCHAR), CASE WHEN loc = 1 THEN 'excluded' ELSE 'unnamed' END, doc_id, NULL, 1 FROM g WHERE grp % 5 >= 3""")
def apply_merge_decisions(spark, d):
    return _merge_rounds(spark, d).select("out_id", "kind", "doc_id", "merged_title", "times")


@query("merged_fields", "J6", f"""
{_J6_GROUPS},
m AS (SELECT grp || '/0' AS out_id, 'merged' AS kind, 1 - loc AS ord, doc_id, source, n_chars, 7 AS given FROM g WHERE grp % 5 = 0 AND loc IN (0, 1)
  UNION ALL SELECT grp || '/1', 'merged', 2 - loc, doc_id, source, n_chars, NULL FROM g WHERE grp % 5 = 0 AND loc IN (1, 2)
  UNION ALL SELECT CAST(doc_id AS VARCHAR), CASE WHEN grp % 5 = 1 THEN 'kept' WHEN grp % 5 = 2 THEN 'undecided' WHEN grp % 5 = 0 OR loc = 1 THEN 'excluded' ELSE 'unnamed' END, 0, doc_id, source, n_chars, NULL
  FROM g WHERE grp % 5 <> 0 OR loc = 3)
SELECT out_id, kind, count(*) AS members, arg_min(source, ord) AS title_source, CAST(coalesce(max(given), round_even(avg(n_chars), 0)) AS BIGINT) AS score FROM m GROUP BY out_id, kind""")
def merged_fields(spark, d):
    items = table(spark, d, "documents").select("doc_id", F.col("source").alias("title_source"), F.col("n_chars").alias("score"))
    return N.merged_fields(_merge_rounds(spark, d), items, "doc_id", ["title_source"], ["score"])


@query("overlapping_batches", "J7", """
WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS z, count(*) OVER (PARTITION BY lang) AS t FROM documents)
SELECT lang, doc_id, 'a' || (z // 30) AS batch, CAST(z % 30 AS INTEGER) AS local FROM r
UNION ALL SELECT lang, doc_id, 'b' || ((z - 15) // 30), CAST((z - 15) % 30 AS INTEGER) FROM r WHERE z >= 15 AND least(30, t - 15 - ((z - 15) // 30) * 30) >= 2""")
def overlapping_batches(spark, d):
    docs = table(spark, d, "documents").select("lang", "doc_id")
    return N.overlapping_batches(docs, ["lang"], [F.col("doc_id")], 30)


def _suggested(spark, d):
    n = F.col("doc_id")
    docs = table(spark, d, "documents")
    return docs.filter("doc_id % 10 in (0, 1)").select(
        F.array(n, n + 1).alias("members"), F.concat(F.lit("r"), n.cast("string")).alias("reason"))


@query("dedupe_groups", "J8", """
SELECT doc_id, CASE WHEN doc_id % 10 IN (1, 2) THEN doc_id - doc_id % 10 ELSE doc_id END AS root FROM documents""")
def dedupe_groups(spark, d):
    return N.dedupe_groups(table(spark, d, "documents").select("doc_id"), "doc_id", _suggested(spark, d), "members")


@query("group_notes", "J8", """
SELECT doc_id - doc_id % 10 AS root, CAST(doc_id % 10 + 1 AS BIGINT) AS ord, 'r' || doc_id AS note FROM documents WHERE doc_id % 10 IN (0, 1)""")
def group_notes(spark, d):
    s = _suggested(spark, d)
    g = N.dedupe_groups(table(spark, d, "documents").select("doc_id"), "doc_id", s, "members")
    return N.group_notes(g, "doc_id", s, "members", "reason")


@query("refine_field", "J9", f"""
SELECT id, md5(CASE WHEN n % 3 = 0 THEN {B.sql_trim("substr(content, 1, 30)")} ELSE content END) AS description, n % 3 = 0 AS refined
FROM (SELECT *, doc_id AS n FROM ({REVIEWS_SQL})) WHERE true""")
def refine_field(spark, d):
    r = reviews(spark, d).select(
        "id", F.col("content").alias("description"),
        F.when(F.col("doc_id") % 3 == 0, F.regexp_replace(F.substring("content", 1, 30), f"^{B.SP}+|{B.SP}+$", "")).when(F.col("doc_id") % 3 == 1, " ").alias("reply"))
    out = N.refine_field(r, "description", "reply")
    return out.select("id", F.md5("description").alias("description"), "refined")


_FIRST = "string_split(content, chr(10))[1]"


@query("translate_missing", "J10", f"""
WITH low AS ({REGISTRY["is_low_quality_comment"].sql}), c AS (SELECT c.* FROM ({COMMENTS_SQL}) c JOIN low ON low.id = c.id WHERE NOT low.low AND c.date >= '2024-02-01')
SELECT id, true AS has_translation, CAST(length(CASE WHEN id % 4 = 0 THEN 'é' || substr(content, 1, 20) WHEN contains(content, 'der') THEN 'ê ' || {_FIRST} ELSE 'é ' || {_FIRST} END) AS INTEGER) AS chars FROM c""")
def translate_missing(spark, d):
    c = comments(spark, d)
    done = c.filter("id % 4 = 0").select("id", F.concat(F.lit("é"), F.substring("content", 1, 20)).alias("content_zh"))
    good = ~quality.is_low_quality_comment("content", B.PHRASES)
    recent = dates.recent_only("date", "2024-02-01", keep_unparsed=True)
    client = N.with_fallback
    out, _ = N.translate_missing(
        c, done, good, recent, lambda: client([B.LineClient("é ", fail="der"), B.LineClient("ê ")]), 4, "À-ÿ")
    return out.select("id", "has_translation", F.length("content_out").alias("chars"))


class _Measures:
    """An embedding client whose vectors SQL can tell: length, e's and blanks."""

    def __call__(self, texts):
        return [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in texts]


_COUNT = "CAST(length(t) - length(replace(t, '{}', '')) AS DOUBLE)"


@query("embed_text_stored", "J11", f"""
SELECT doc_id, CAST(length(t) AS DOUBLE) AS size, {_COUNT.format("e")} AS e, {_COUNT.format(" ")} AS blanks, (SELECT count(DISTINCT coalesce(text, '')) FROM documents) AS embedded
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def embed_text_stored(spark, d):
    """Vectors of all documents in two runs; the second embeds what the first did not."""
    docs, store = table(spark, d, "documents").select("doc_id", "text"), scratch_path(spark, "vectors")
    N.embed_text_stored(docs.filter("lang = 'en'"), "text", "vec", _Measures, store)
    out = N.embed_text_stored(docs, "text", "vec", _Measures, store)
    embedded = spark.read.parquet(store).count()
    return out.select("doc_id", F.col("vec")[0].alias("size"), F.col("vec")[1].alias("e"), F.col("vec")[2].alias("blanks"), F.lit(embedded).alias("embedded"))
