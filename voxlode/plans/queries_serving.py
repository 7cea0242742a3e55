"""Serving queries and incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates as A
from ..operators import ranking as R
from ..operators import serving as V
from ..session import scratch_path
from ..sources import current
from ..sources.tables import ATOMS_SQL, atoms, table
from ..streaming import increments as L
from .registry import query

_BY = ["category", "label"]


def served(spark, d):
    """Opportunities as the read side sees them: one per (category, label)."""
    a = atoms(spark, d, statements=False)
    stats = a.groupBy(*_BY).agg(F.count(F.lit(1)).alias("mention_count"), F.max("type").alias("demand_type"))
    prod = A.distribution_map(a, _BY, "product", 50).withColumnRenamed("dist", "product_breakdown")
    src = A.distribution_map(a, _BY, "source", 10).withColumnRenamed("dist", "source_breakdown")
    top = R.top_k(a.filter("pos = 0"), _BY, [F.desc("source_date"), F.col("atom_id")], 5, "_r")
    ev = top.groupBy(*_BY).agg(
        F.array_sort(F.collect_list(F.struct("_r", F.col("source_date").alias("date"), F.col("product").alias("app_name"), F.col("source").alias("channel")))).alias("evidence")
    )
    name = F.concat_ws("_", "category", F.col("label").cast("string"))
    return stats.join(prod, _BY).join(src, _BY).join(ev, _BY).withColumns({
        "id": name, "title": F.concat(F.lit("Need "), name), "description": F.concat(F.lit("About "), "demand_type"),
        "user_voice": F.concat(F.lit("voice "), F.col("label").cast("string")), "apps": F.map_keys("product_breakdown"),
        "ai_keywords": F.array("category", F.lit("k1"), F.lit("k2"), F.lit("k3"), F.lit("k4")),
        "ai_intervention_type": F.when(F.col("label") % 2 == 0, "light").otherwise("heavy"),
        "final_score": F.col("label") % 4 + F.col("mention_count") / 1000,
        "cross_product_relevance": F.when(F.col("label") % 3 == 0, F.array("category")).otherwise(F.array().cast("array<string>")),
    })


_SERVED = f"""
a AS ({ATOMS_SQL}),
c AS (SELECT category, label, product, count(*) AS n FROM a GROUP BY ALL),
pc AS (SELECT category, label, max(n) / sum(n) AS share, count(*) AS k, list(product ORDER BY product) AS apps FROM c GROUP BY category, label),
ev AS (SELECT category, label, source_date, row_number() OVER (PARTITION BY category, label ORDER BY source_date DESC, atom_id) AS r FROM a WHERE pos = 0),
le AS (SELECT category, label, max(source_date) AS latest FROM ev WHERE r <= 5 GROUP BY category, label),
s AS (SELECT a.category, a.label, a.category || '_' || a.label AS id, count(*) AS mention_count, max(type) AS demand_type, count_if(source = 'play') AS play, count_if(source = 'forum') AS forum,
  a.label % 4 + count(*) / 1000 AS final_score FROM a GROUP BY a.category, a.label),
needs AS (SELECT s.*, pc.apps, le.latest, share < 0.7 AND k >= 3 AS is_cross, share < 0.4 AND k > 6 AS dirty FROM s JOIN pc USING (category, label) JOIN le USING (category, label))"""


@query("list_needs", "M1", f"WITH {_SERVED} SELECT id, CAST(mention_count AS BIGINT) AS mention_count, is_cross AS is_cross_product FROM needs WHERE NOT dirty")
def list_needs(spark, d):
    return V.list_needs(served(spark, d)).select("id", "mention_count", "is_cross_product")


@query("search_needs", "M2", f"""
WITH {_SERVED} SELECT id FROM needs WHERE NOT dirty AND contains(lower('need ' || id || ' about ' || demand_type || ' voice ' || label || ' ' || array_to_string(apps, ' ') || ' ' || category || ' k1 k2 k3 k4'), 'src1')""")
def search_needs(spark, d):
    n = V.list_needs(served(spark, d))
    return V.search(n, " SRC1 ", ["title", "description", "user_voice"], ["apps", "ai_keywords"]).select("id")


@query("filter_facets", "M3", f"""
WITH {_SERVED} SELECT id FROM needs WHERE NOT dirty AND (play > 0 OR forum > 0) AND demand_type IN ('feature', 'problem') AND is_cross""")
def filter_facets(spark, d):
    n = V.list_needs(served(spark, d))
    return V.filter_facets(n, ["play", "forum"], ["feature", "problem"], True).select("id")


@query("sort_page", "M4", f"""
WITH {_SERVED} SELECT * FROM (SELECT 'recent' AS mode, id FROM needs WHERE NOT dirty ORDER BY latest DESC, id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'mentions', id FROM needs WHERE NOT dirty ORDER BY mention_count DESC, id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'score', id FROM needs WHERE NOT dirty ORDER BY final_score DESC, id LIMIT 10)""")
def sort_page(spark, d):
    n = V.list_needs(served(spark, d))
    out = None
    for mode in ("recent", "mentions", "score"):
        p = V.sort_page(n, mode, 5, 1).select(F.lit(mode).alias("mode"), "id")
        out = p if out is None else out.unionByName(p)
    return out


@query("filter_by_attribute", "M5", f"""
WITH {_SERVED} SELECT 'light' AS attribute, id FROM needs WHERE label % 2 = 0 UNION ALL SELECT 'cross', id FROM needs WHERE label % 3 = 0 UNION ALL SELECT 'id', id FROM needs WHERE id = 'en_3'""")
def filter_by_attribute(spark, d):
    s = served(spark, d)
    a = V.filter_by_attribute(s, intervention="light").select(F.lit("light").alias("attribute"), "id")
    b = V.filter_by_attribute(s, cross_category="cross_product_relevance").select(F.lit("cross").alias("attribute"), "id")
    return a.unionByName(b).unionByName(V.filter_by_attribute(s, row_id="en_3").select(F.lit("id").alias("attribute"), "id"))


_CHANNELS = ["play", "store"]


@query("need_view", "M6 H4", f"""
WITH {_SERVED}, o AS (SELECT category, label, string_agg(product, ',' ORDER BY n DESC, product) AS apps FROM c GROUP BY category, label),
x AS (SELECT a.category, a.label, a.doc_id, a.source, a.source_date, a.atom_id, coalesce(regexp_matches(d.text, '[À-ÿ]'), false) AS p FROM a JOIN documents d ON d.doc_id = a.doc_id WHERE a.pos = 0),
y AS (SELECT * FROM x QUALIFY p OR NOT bool_or(p) OVER (PARTITION BY category, label)),
m AS (SELECT category, label, source, count(*) AS n FROM y GROUP BY ALL), t AS (SELECT category, label, string_agg(source || n, ',' ORDER BY n DESC, source) AS sources FROM m GROUP BY category, label),
z AS (SELECT *, row_number() OVER (PARTITION BY category, label, source ORDER BY source_date DESC, atom_id) AS turn FROM y),
e AS (SELECT *, row_number() OVER (PARTITION BY category, label ORDER BY turn, CASE source WHEN 'play' THEN 0 WHEN 'store' THEN 1 ELSE 2 END) AS r FROM z QUALIFY r <= 5),
f AS (SELECT category, label, string_agg('doc_' || doc_id, ',' ORDER BY r) AS refs FROM e GROUP BY category, label)
SELECT needs.id, o.apps, needs.category || ',k1,k2,k3' AS keywords, t.sources, f.refs AS "references" FROM needs JOIN o USING (category, label) JOIN t USING (category, label) JOIN f USING (category, label) WHERE NOT dirty""")
def need_view(spark, d):
    """Served needs with references: of all reviews of a need, or of those in the target script if it has any, channels in turn."""
    # One row per review, the one of its first atom; the script is judged before the join, so that no text goes along.
    script = table(spark, d, "documents").select("doc_id", F.coalesce(text.has_script("text", "À-ÿ"), F.lit(False)).alias("preferred"))
    rows = atoms(spark, d, statements=False).filter("pos = 0").select(*_BY, "doc_id", "source", "source_date", "atom_id", F.col("source_review_id").alias("id")).join(script, "doc_id")
    rows = rows.withColumn("need", F.struct(*_BY))
    counts = R.channel_counts(rows, "need", "preferred", "source").select("need", F.col("source").alias("name"), "n")
    sources = counts.groupBy("need").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "name", "n"))).alias("mention_sources"))
    turns = R.round_robin(rows, "need", "source", F.col("preferred"), [F.desc("source_date"), F.col("atom_id")], _CHANNELS)
    chosen = turns.groupBy("need").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("references"))
    needs = V.list_needs(served(spark, d)).withColumn("need", F.struct(*_BY)).join(sources, "need").join(chosen, "need")
    v = V.need_view(needs)
    src = F.array_join(F.transform("mention_sources", lambda e: F.concat(e["name"], e["n"].cast("string"))), ",")
    refs = F.array_join(F.transform("references", lambda e: e["id"]), ",")
    return v.select("id", F.array_join("apps", ",").alias("apps"), F.array_join("keywords", ",").alias("keywords"), src.alias("sources"), refs.alias("references"))


# ---------------------------------------------------------------- increments


def _main_and_new(spark, d):
    v = table(spark, d, "embeddings")
    main = v.filter("vec_id % 4 <> 0").select(
        F.concat(F.lit("m"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("id"), F.concat(F.lit("c"), F.col("label").cast("string")).alias("category"), "embedding",
        (F.col("vec_id") % 17).cast("bigint").alias("mention_count"), F.lit(False).alias("is_new"), F.lit("2024-01-01").alias("discovered_at"),
        F.lit(None).cast("string").alias("last_updated_at"), F.lit("P2").alias("priority"))
    new = v.filter("vec_id % 4 = 0").select(F.col("vec_id").alias("ord"), F.concat(F.lit("c"), F.col("label").cast("string")).alias("category"), "embedding", (F.col("label") + 1).alias("size"))
    return main, new


_MERGED_SQL = """
WITH p AS (SELECT n.vec_id AS n, m.vec_id AS m, n.label + 1 AS size, list_cosine_similarity(n.embedding::DOUBLE[], m.embedding::DOUBLE[]) AS sim
  FROM embeddings n JOIN embeddings m ON n.label = m.label AND n.vec_id % 4 = 0 AND m.vec_id % 4 <> 0),
b AS (SELECT * FROM p WHERE sim >= 0.35 QUALIFY row_number() OVER (PARTITION BY n ORDER BY round(sim, 12) DESC, m) = 1),
g AS (SELECT m, sum(size) AS add FROM b GROUP BY m)
SELECT 'm' || lpad(CAST(vec_id AS VARCHAR), 9, '0') AS id, CAST(vec_id % 17 + coalesce(add, 0) AS BIGINT) AS mention_count, false AS is_new, CASE WHEN add IS NOT NULL THEN '2024-07-01' END AS last_updated_at
FROM embeddings LEFT JOIN g ON g.m = vec_id WHERE vec_id % 4 <> 0
UNION ALL SELECT 'c' || label || '_demand_new_2024-07-01_' || vec_id, CAST(label + 1 AS BIGINT), true, NULL FROM embeddings WHERE vec_id % 4 = 0 AND vec_id NOT IN (SELECT n FROM b)"""


@query("merge_increment", "L3 F8", _MERGED_SQL)
def merge_increment(spark, d):
    main, new = _main_and_new(spark, d)
    return L.merge_increment(main, new, "embedding", "2024-07-01", 0.35).select("id", "mention_count", "is_new", "last_updated_at")


@query("merge_stream", "L3 A11", _MERGED_SQL)
def merge_stream(spark, d):
    """The same merge driven by a stream of new rows."""
    main, new = _main_and_new(spark, d)
    base = scratch_path(spark, "stream")
    main.write.parquet(f"{base}/list/snapshot=0000")
    new.repartition(1).write.parquet(f"{base}/landed")
    stream = L.landed_stream(spark, f"{base}/landed", new.schema, "parquet")
    q = L.merge_stream(
        stream, f"{base}/list", f"{base}/checkpoint",
        lambda m, b: L.merge_increment(m, b, "embedding", "2024-07-01", 0.35), lambda e: f"{e + 1:04d}")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/list/snapshot=0001")
    return out.select("id", "mention_count", "is_new", "last_updated_at")


@query("merge_list_stream", "L3 A11 L5", _MERGED_SQL)
def merge_list_stream(spark, d):
    """The merge by several micro-batches, each of which writes only the categories it touches."""
    main, new = _main_and_new(spark, d)
    base = scratch_path(spark, "current")
    current.write_list(main, f"{base}/list", "0000")
    new.repartition("category").write.parquet(f"{base}/landed")
    stream = L.landed_stream(spark, f"{base}/landed", new.schema, "parquet", files_per_batch=2)
    q = L.merge_list_stream(
        stream, f"{base}/list", f"{base}/checkpoint", lambda m, b: L.merge_increment(m, b, "embedding", "2024-07-01", 0.35), lambda e: f"{e + 1:04d}")
    q.awaitTermination()
    return current.read_list(spark, f"{base}/list").select("id", "mention_count", "is_new", "last_updated_at")


@query("expire_new", "L4", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN false WHEN event_id % 7 = 0 THEN false WHEN event_id % 5 = 0 THEN true ELSE strftime(ts, '%Y-%m-%d') >= '2024-01-13' END AS is_new FROM events""")
def expire_new(spark, d):
    n = F.col("event_id")
    found = F.when(n % 7 == 0, "soon").when(n % 5 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, d, "events").select("event_id", L.expire_new(n % 3 != 0, found, "2024-01-20", 7).alias("is_new"))


@query("ingest_increment", "L1", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def ingest_increment(spark, d):
    base = scratch_path(spark, "ingest")
    events = table(spark, d, "events")
    stream = L.landed_stream(spark, d, events.schema, "parquet", glob="events.parquet")
    L.ingest_increment(stream, "ts", "2024-01-30", 10, f"{base}/out", f"{base}/checkpoint", ["event_type"]).awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{base}/out").select("event_id", "event_type")


@query("dedupe_stream", "L2", "SELECT DISTINCT event_id // 2 AS delivered FROM events")
def dedupe_stream(spark, d):
    base = scratch_path(spark, "dedupe")
    events = table(spark, d, "events")
    stream = L.landed_stream(spark, d, events.schema, "parquet", glob="events.parquet")
    ids = stream.select(F.floor(F.col("event_id") / 2).alias("delivered"), F.col("ts").cast("timestamp"))
    q = L.dedupe_stream(ids, "delivered", "ts", "2 days").writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/out")
    q.awaitTermination()
    return spark.read.schema("delivered bigint, ts timestamp").parquet(f"{base}/out").select("delivered")
