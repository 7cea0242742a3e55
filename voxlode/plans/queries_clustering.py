"""Queries over similarity, graphs and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality, text
from ..operators import clustering as C
from ..operators import joins as J
from ..operators import similarity as S
from ..operators.graph import connected_components
from ..operators.ranking import dedupe_near
from ..session import cut
from ..sources.tables import REVIEWS_SQL, reviews, table
from . import bindings as B
from .queries_joins import MERGE_RULES
from .queries_text import _TERMS
from .registry import query



def _vec(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "embedding", "label")


_PAIRS = """SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3"""


@query("similar_pairs", "F7", f"SELECT i, j, round(sim, 6)::DOUBLE AS sim FROM ({_PAIRS})")
def similar_pairs(spark, d):
    return S.similar_pairs(_vec(spark, d), "vec_id", "embedding", 0.3, every=True, digits=6)


@query("similar_pairs_levels", "F7", f"SELECT i, j, round(sim, 6)::DOUBLE AS sim FROM ({_PAIRS})")
def similar_pairs_levels(spark, d):
    """The same pairs through a tree of small cells, several levels deep, where the vectors form clusters."""
    return S.similar_pairs(_vec(spark, d), "vec_id", "embedding", 0.3, block=32, fan=4, every=True, digits=6)


@query("nearest_match_levels", "F8", """
WITH p AS (SELECT n.vec_id AS new_id, m.vec_id AS main_id, list_cosine_similarity(n.embedding::DOUBLE[], m.embedding::DOUBLE[]) AS sim FROM embeddings n JOIN embeddings m ON n.vec_id % 4 = 0 AND m.vec_id % 4 <> 0)
SELECT new_id, main_id, round(sim, 6)::DOUBLE AS sim FROM p WHERE sim >= 0.3 QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY round(sim, 12) DESC, main_id) = 1""")
def nearest_match_levels(spark, d):
    rows = _vec(spark, d)
    new = rows.filter("vec_id % 4 = 0").select(F.col("vec_id").alias("new_id"), "embedding")
    main = rows.filter("vec_id % 4 <> 0").select(F.col("vec_id").alias("main_id"), "embedding")
    return S.nearest_match(new, main, "new_id", "main_id", "embedding", 0.3, block=32, fan=4).select("new_id", "main_id", F.round("sim", 6).alias("sim"))


# Copies, and vectors without direction, of some of the given ones.
_MIXED_SQL = """SELECT vec_id, embedding::DOUBLE[] AS embedding, label FROM embeddings
UNION ALL SELECT vec_id + 1000000, embedding::DOUBLE[], label FROM embeddings WHERE vec_id % 10 = 0
UNION ALL SELECT vec_id + 2000000, [0.0::DOUBLE for x in embedding], label FROM embeddings WHERE vec_id % 50 = 0"""


def _mixed(spark, d):
    """The given vectors, copies and zero vectors; the ids of the latter are shifted by whole millions beyond all given ids."""
    v = _vec(spark, d).withColumn("embedding", F.col("embedding").cast("array<double>"))
    low, high = v.agg(F.coalesce(F.min("vec_id"), F.lit(0)), F.coalesce(F.max("vec_id"), F.lit(0))).first()
    shift = ((high - min(low, 0)) // 1_000_000 + 1) * 1_000_000
    copies = v.filter("vec_id % 10 = 0").withColumn("vec_id", F.col("vec_id") + shift)
    zeros = v.filter("vec_id % 50 = 0").select(F.col("vec_id") + 2 * shift, F.transform("embedding", lambda x: F.lit(0.0)), "label")
    return v.unionByName(copies).union(zeros)


@query("similar_pairs_by", "F7", f"""
WITH r AS ({_MIXED_SQL})
SELECT a.vec_id AS i, b.vec_id AS j, round(list_cosine_similarity(a.embedding, b.embedding), 6)::DOUBLE AS sim FROM r a JOIN r b ON a.label = b.label AND a.vec_id < b.vec_id
WHERE a.vec_id < 2000000 AND b.vec_id < 2000000 AND list_cosine_similarity(a.embedding, b.embedding) >= 0.3""")
def similar_pairs_by(spark, d):
    """All pairs inside a label, those of copies too."""
    return S.similar_pairs(_mixed(spark, d), "vec_id", "embedding", 0.3, by="label", every=True, digits=6)


@query("nearest_match_by", "F8", f"""
WITH r AS ({_MIXED_SQL}), p AS (
  SELECT n.vec_id AS new_id, m.vec_id AS main_id, list_cosine_similarity(n.embedding, m.embedding) AS sim
  FROM r n JOIN r m ON n.label = m.label AND n.vec_id % 4 = 0 AND m.vec_id % 4 <> 0 AND n.vec_id < 2000000 AND m.vec_id < 2000000)
SELECT new_id, main_id, round(sim, 6)::DOUBLE AS sim FROM p WHERE sim >= 0.3 QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY round(sim, 12) DESC, main_id) = 1""")
def nearest_match_by(spark, d):
    rows = _mixed(spark, d)
    new = rows.filter("vec_id % 4 = 0").select(F.col("vec_id").alias("new_id"), "embedding", "label")
    main = rows.filter("vec_id % 4 <> 0").select(F.col("vec_id").alias("main_id"), "embedding", "label")
    m = S.nearest_match(new, main, "new_id", "main_id", "embedding", 0.3, by="label")
    return m.select("new_id", "main_id", F.round("sim", 6).alias("sim"))


@query("nearest_match", "F8", """
WITH p AS (SELECT n.vec_id AS new_id, m.vec_id AS main_id, list_cosine_similarity(n.embedding::DOUBLE[], m.embedding::DOUBLE[]) AS sim
  FROM embeddings n JOIN embeddings m ON n.vec_id % 4 = 0 AND m.vec_id % 4 <> 0)
SELECT new_id, main_id, round(sim, 6)::DOUBLE AS sim FROM p WHERE sim >= 0.3 QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY round(sim, 12) DESC, main_id) = 1""")
def nearest_match(spark, d):
    v = _vec(spark, d)
    new = v.filter("vec_id % 4 = 0").select(F.col("vec_id").alias("new_id"), "embedding")
    main = v.filter("vec_id % 4 <> 0").select(F.col("vec_id").alias("main_id"), "embedding")
    m = S.nearest_match(new, main, "new_id", "main_id", "embedding", 0.3)
    return m.select("new_id", "main_id", F.round("sim", 6).alias("sim"))


@query("connected_components", "K3", f"""
WITH RECURSIVE p AS ({_PAIRS.replace('0.3', '0.36')}),
e AS (SELECT i AS a, j AS b FROM p UNION SELECT j, i FROM p),
r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach)
SELECT node, min(reach) AS component FROM r GROUP BY node""")
def components(spark, d):
    return connected_components(S.similar_edges(_vec(spark, d), "vec_id", "embedding", 0.36))


@query("average_linkage", "K1")
def average_linkage(spark, d):
    return C.average_linkage(_vec(spark, d), "vec_id", "embedding", 0.62)


@query("split_noise", "K2", f"""
WITH m AS (SELECT lang, doc_id, substr(text, 1, 4) AS k FROM documents),
s AS (SELECT lang, k, count(*) AS size, min(doc_id) AS f FROM m GROUP BY ALL HAVING count(*) >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY size DESC, f) AS rank FROM s)
SELECT m.lang, m.doc_id, CASE WHEN r.rank IS NULL THEN 'noise' ELSE m.lang || '_c' || CASE WHEN r.rank < 1000 THEN lpad(CAST(r.rank AS VARCHAR), 3, '0') ELSE CAST(r.rank AS VARCHAR) END END AS cluster_id
FROM m LEFT JOIN r ON r.lang = m.lang AND r.k = m.k""")
def split_noise(spark, d):
    m = table(spark, d, "documents").select("lang", "doc_id", F.substring("text", 1, 4).alias("cluster"))
    clusters, noise = C.split_noise(m, "lang", "doc_id")
    kept = m.join(clusters.select("lang", "cluster", "cluster_id"), ["lang", "cluster"])
    return kept.select("lang", "doc_id", "cluster_id").unionByName(noise.select("lang", "doc_id", F.lit("noise").alias("cluster_id")))


@query("centroid_representatives", "H2", """
WITH u AS (SELECT label, vec_id, [x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) for x in embedding::DOUBLE[]] AS v FROM embeddings),
e AS (SELECT label, unnest(range(len(v))) AS p, unnest(v) AS x FROM u),
c AS (SELECT label, p, avg(x) AS x FROM e GROUP BY label, p), m AS (SELECT label, list(x ORDER BY p) AS m FROM c GROUP BY label),
s AS (SELECT u.label, u.vec_id, round(list_cosine_similarity(u.v, m.m), 9) AS sim FROM u JOIN m USING (label))
SELECT label, vec_id, CAST(row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 5""")
def centroid_representatives(spark, d):
    return C.centroid_representatives(_vec(spark, d), "label", "vec_id", "embedding").select("label", "vec_id", "rank")


@query("split_oversize", "K4")
def split_oversize(spark, d):
    return C.split_oversize(_vec(spark, d), "label", "vec_id", "embedding").select("label", "vec_id", "part", "part_size", "single")


def _keyed(spark, d):
    r = reviews(spark, d, rated=False).select(
        "doc_id", "channel", text.top_terms("content", B.WORD, 5, B.STOPWORDS).alias("terms"),
        text.extract_intent("content", B.INTENTS).alias("intent"),
        quality.is_tech_issue("content", ["idiot", "license"], B.NEED_PATTERNS).alias("tech"),
    )
    # Stored, so that terms are made once for the filter on them and for every use of the keys.
    return C.key_clusters(cut(r.filter("intent is not null and not tech")), "terms", "intent", F.col("tech"), "doc_id")


_KEYED_SQL = f"""
t AS (SELECT doc_id, unnest(terms) AS term, unnest(range(len(terms))) AS pos FROM (SELECT doc_id, {_TERMS} AS terms FROM documents)),
c AS (SELECT doc_id, term, count(*) AS n, min(pos) AS p FROM t GROUP BY ALL),
k AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, p) AS r FROM c QUALIFY r <= 2),
g AS (SELECT doc_id, string_agg(term, '_' ORDER BY term) AS cluster_key FROM k GROUP BY doc_id),
keyed AS (SELECT g.doc_id, g.cluster_key FROM g JOIN documents d ON d.doc_id = g.doc_id
  WHERE ({' OR '.join(f"regexp_matches(d.text, {B.q(p)})" for p, _ in B.INTENTS)})
  AND NOT ({B.sql_contains_any('lower(d.text)', ['idiot', 'license'])} AND NOT regexp_matches(d.text, {B.q('|'.join(f'(?:{p})' for p in B.NEED_PATTERNS))})))"""


@query("key_clusters", "K5", f"WITH {_KEYED_SQL} SELECT cluster_key, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first FROM keyed GROUP BY cluster_key")
def key_clusters(spark, d):
    return _keyed(spark, d).groupBy("cluster_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


@query("greedy_merge_clusters", "K6")
def greedy_merge_clusters(spark, d):
    k = _keyed(spark, d)
    sizes = cut(k.groupBy("cluster_key").agg(F.count(F.lit(1)).alias("count"), F.min("doc_id").alias("first")))
    led = C.greedy_merge_clusters(sizes, C.cluster_terms(k, "terms", "doc_id"), min_count=2, overlap=0.5)
    return led.join(sizes, "cluster_key").groupBy("leader").agg(F.count(F.lit(1)).alias("clusters"), F.sum("count").alias("n"))


_TARGET = """CASE WHEN category = 'en' AND (app_name = 'one group' OR contains(app_name, 'src1') OR contains('src1', app_name) OR contains('source src2 of', app_name)) THEN 'one group'
  WHEN category = 'en' AND contains(app_name, 'src3') THEN 'two group' WHEN category = 'fr' AND (contains(app_name, 'src2') OR contains('src2', app_name)) THEN 'deux' ELSE app_name END"""


@query("merge_by_rules", "K7 F6", f"""
WITH i AS (SELECT category, app_name, count(*) AS mentions, min(doc_id) AS ord FROM ({REVIEWS_SQL}) GROUP BY ALL),
t AS (SELECT *, {_TARGET} AS target FROM i), r AS (SELECT *, row_number() OVER (PARTITION BY category, target ORDER BY ord) AS r FROM t),
g AS (SELECT category, target, CAST(count(*) AS BIGINT) AS members, CAST(sum(mentions) AS BIGINT) AS mentions, string_agg(CASE WHEN r <= 3 THEN app_name END, ', ' ORDER BY r) AS names FROM r GROUP BY category, target)
SELECT category, target, members, mentions, CASE WHEN members > 1 THEN 'merged ' || names || ' and others, ' || members || ' groups, ' || mentions || ' mentions' ELSE mentions || ' mentions' END AS description FROM g""")
def merge_by_rules(spark, d):
    items = reviews(spark, d).groupBy("category", F.col("app_name").alias("title")).agg(
        F.count(F.lit(1)).alias("mentions"), F.min("doc_id").alias("ord")
    )
    return C.merge_by_rules(items, MERGE_RULES, "ord").drop("names")


@query("consolidate_with_evidence", "K7 E7 H8 F2")
def consolidate_with_evidence(spark, d):
    """Merged groups with their best evidence and the solution of the group title."""
    from ..functions.scores import sample_score

    r = reviews(spark, d).withColumn("target", J.resolve_merge_target("app_name", "category", MERGE_RULES))
    score = sample_score(
        "content", F.col("rating") / 5, F.lit(None).cast("double"), F.col("target"), ["was "], ["ing", "ung"], ["for"], ["That"], ["idiot"], []
    )
    rated = r.select(F.concat_ws(":", "category", "target").alias("grp"), "target", "id", "content", score.alias("score"))
    best = dedupe_near(rated, "grp", "content", "score", "id")
    dim = table(spark, d, "documents").groupBy("source").agg(F.min("doc_id").alias("ord")).withColumn(
        "solution", F.concat(F.lit("solve "), "source")
    )
    return J.tiered_lookup(best.select("grp", "target", "id", "rank"), dim, "target", "source", "ord", ["solution"])


@query("embed_text", "J11")
def embed_text(spark, d):
    from ..operators.enrich import embed_text_tfidf

    docs = table(spark, d, "documents").select("doc_id", "text")
    v = embed_text_tfidf(docs, "text", "vec", dims=64, carry=["doc_id"])
    return v.select("doc_id", F.size("vec").alias("dims"), F.round(S.dot("vec", "vec"), 6).alias("norm"))


