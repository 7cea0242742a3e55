"""From clusters of need atoms to ranked needs: label, pair, split, decide, dedupe, refine, score, evidence.

Every step is a stage of a ledger (``operators/ledger.py``): a run that was cut off goes on where it stopped, and no prompt is asked twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.text import map_value
from ..operators import enrich as N
from ..operators import ranking as R
from ..operators.clustering import split_oversize
from ..operators.graph import connected_components
from ..operators.ledger import Ledger, ReplySource, Staged, from_table
from ..operators.similarity import similar_edges
from ..session import scratch_path
from ..sources.tables import ATOMS_SQL, atoms, table
from .registry import query

#: Vectors (id, vec) of texts (id, text).
Embedder = Callable[[DataFrame], DataFrame]

FIELDS = ["category", "title", "description", "demand_type", "demand_tier", "ai_intervention_type", "ai_description"]
DECISION = (
    "should_merge boolean, merge_groups array<struct<merged_title:string,merged_description:string,merged_demand_type:string,merged_demand_tier:int,"
    "merged_ai_score:int,merged_ai_intervention_type:string,merged_ai_description:string,cluster_indices:array<int>>>, exclude_indices array<int>"
)
SUGGESTION = "merge_groups array<struct<indices:array<int>,merged_title:string,merged_description:string,reason:string>>"


@dataclass(frozen=True)
class Settings:
    # Similarity of candidate pairs, sizes of groups, batches and samples.
    similar: float = 0.75
    group: int = 6
    label_statements: int = 8
    refine_statements: int = 6
    batch: int = 30
    evidence: int = 5
    forum: str = "forum"
    label: str = "Name the need of category {category} behind these {size} statements as JSON\n{statements}"
    decide: str = "Which of these clusters are one need? JSON with should_merge, merge_groups, exclude_indices\n{clusters}"
    dedupe: str = "Which of these needs are the same? JSON with merge_groups\n{needs}"
    refine: str = "Describe the need {title} in the light of these of {size} statements, as JSON\n{statements}"


def embedding_text() -> Column:
    """What a labelled cluster is compared by: title, fingerprint and the start of the description."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.concat_ws(" | ", part("title"), part("semantic_fingerprint"), F.substring(part("description"), 1, 120))


def atom_text() -> Column:
    """What an atom is clustered by: its product, feature and statement together."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.concat(F.lit("["), part("atom_product"), F.lit("] "), part("feature"), F.lit(": "), part("need_statement"))


def parsed(replies: DataFrame, schema: str) -> DataFrame:
    """(id, fields of the schema) of the replies that are JSON objects."""
    return replies.select("id", N.parsed_or_error("reply", schema).alias("_r")).filter("_r.value is not null").select("id", "_r.value.*")


def numbered(lines: DataFrame, by: list[str], name: str) -> DataFrame:
    """The lines (local, line) of each group as one text."""
    packed = F.array_sort(F.collect_list(F.struct("local", "line")))
    return lines.groupBy(*by).agg(F.array_join(F.transform(packed, lambda e: F.concat(F.lit("["), e["local"].cast("string"), F.lit("] "), e["line"])), "\n").alias(name))


def labelled(ledger: Ledger, members: DataFrame, replies: ReplySource, s: Settings) -> DataFrame:
    """Clusters with the fields of their label and their size; without a title a cluster drops out."""
    facts = members.groupBy("category", "cluster_id").agg(F.count(F.lit(1)).alias("size"))
    said = N.numbered_statements(members, ["cluster_id"], "need_statement", "weight_signal", "atom_id", s.label_statements)
    values = {c: F.col(c) for c in ("category", "size", "statements")}
    prompts = facts.join(said, "cluster_id").select(F.col("cluster_id").alias("id"), N.render_prompt(s.label, values).alias("prompt"))
    got = ledger.replies("label", prompts, replies).withColumnRenamed("id", "cluster_id")
    return N.parse_labels(facts.join(got.select("cluster_id", N.strip_fences("reply").alias("reply")), "cluster_id"), "reply")


def candidate_groups(clusters: DataFrame, embed: Embedder, s: Settings) -> DataFrame:
    """(cluster_id, group, local) of clusters that may be one need: similar ones of a category, in parts of bounded size."""
    vecs = embed(clusters.select(F.col("cluster_id").alias("id"), embedding_text().alias("text"))).withColumnRenamed("id", "cluster_id")
    rows = clusters.select("cluster_id", "category").join(vecs, "cluster_id")
    parts = connected_components(similar_edges(rows, "cluster_id", "vec", s.similar, by="category"))
    grouped = rows.join(parts.withColumnRenamed("node", "cluster_id"), "cluster_id").select("cluster_id", F.col("component").alias("of"), "vec")
    split = split_oversize(grouped, "of", "cluster_id", "vec", s.group).filter("not single")
    place = F.row_number().over(W.partitionBy("part").orderBy("cluster_id")) - 1
    return split.select("cluster_id", F.col("part").alias("group"), place.alias("local"))


def merged(ledger: Ledger, clusters: DataFrame, groups: DataFrame, replies: ReplySource, s: Settings) -> DataFrame:
    """One row (out_id, cluster_id, overrides ...) per cluster and output of the decisions; clusters in no group stay alone."""
    line = F.concat_ws(" - ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
    lines = groups.join(clusters, "cluster_id").select("group", "local", line.alias("line"))
    prompts = numbered(lines, ["group"], "clusters").select(F.col("group").alias("id"), N.render_prompt(s.decide, {"clusters": F.col("clusters")}).alias("prompt"))
    decisions = parsed(ledger.replies("decide", prompts, replies), DECISION).withColumnRenamed("id", "group")
    decided = N.apply_merge_decisions(groups, decisions, "group", "cluster_id", "local")
    alone = clusters.join(groups, "cluster_id", "left_anti").select("cluster_id", F.col("cluster_id").alias("out_id"), F.lit("single").alias("kind"))
    return decided.unionByName(alone, allowMissingColumns=True)


def needs_of(decided: DataFrame, clusters: DataFrame) -> DataFrame:
    return N.merged_fields(decided, clusters, "cluster_id", FIELDS, ["ai_score"])


def numbered_needs(needs: DataFrame, decided: DataFrame, members: DataFrame) -> DataFrame:
    """Needs with the number of their atoms, numbered ``n`` by category, tier, AI score and size."""
    size = decided.select("out_id", "cluster_id").join(members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_c")), "cluster_id").groupBy("out_id").agg(F.sum("_c").alias("size"))
    order = [F.col("category"), F.col("demand_tier"), F.desc("ai_score"), F.desc("size"), F.col("out_id")]
    return R.number_rows(needs.join(size, "out_id"), [], order, "n").drop("members", "kind")


def deduped(ledger: Ledger, needs: DataFrame, replies: ReplySource, s: Settings) -> DataFrame:
    """(n, root, title, description, note) of every need: batches of a category, each seen twice, suggest what is the same."""
    batches = N.overlapping_batches(needs, ["category"], [F.col("n")], s.batch)
    line = F.concat(F.lit("("), F.coalesce("demand_type", F.lit("")), F.lit("/T"), F.coalesce(F.col("demand_tier").cast("string"), F.lit("?")), F.lit(") "), F.coalesce("title", F.lit("")), F.lit(" - "), F.substring(F.coalesce("description", F.lit("")), 1, 80))
    batches = batches.withColumn("id", F.concat_ws("/", "category", "batch"))
    prompts = numbered(batches.select("id", "local", line.alias("line")), ["id"], "needs")
    got = ledger.replies("dedupe", prompts.select("id", N.render_prompt(s.dedupe, {"needs": F.col("needs")}).alias("prompt")), replies)
    groups = parsed(got, SUGGESTION).select("id", F.posexplode("merge_groups").alias("g", "m")).select("id", "g", F.posexplode("m.indices").alias("p", "local"), "m")
    found = groups.join(batches.select("id", "local", "n"), ["id", "local"])
    listed = found.groupBy("id", "g").agg(F.array_sort(F.collect_list(F.struct("p", "n"))).alias("_x"), F.first("m").alias("m"))
    suggestions = listed.select("id", "g", F.transform("_x", lambda e: e["n"]).alias("members"), "m.merged_title", "m.merged_description", "m.reason").filter("size(array_distinct(members)) >= 2")
    suggestions = suggestions.withColumn("members", F.array_distinct("members"))
    roots = N.dedupe_groups(needs.select("n"), "n", suggestions, "members").select("n", "root")
    first = F.struct(F.array_min("members").alias("a"), "id", "g")
    owned = suggestions.withColumn("n", F.get("members", 0)).join(roots, "n")
    said = owned.groupBy("root").agg(
        F.min_by("merged_title", first).alias("merged_title"), F.min_by("merged_description", first).alias("merged_description"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(first.alias("o"), F.coalesce("reason", F.lit("")).alias("r")))), lambda e: e["r"]), " | ").alias("note"),
    )
    return roots.join(said, "root", "left")


def one_per_root(needs: DataFrame, roots: DataFrame) -> DataFrame:
    """Merged needs: commonest type by atoms, boldest tier, highest AI score, the rest of the largest member."""
    rows = needs.join(roots, "n")
    largest = F.struct(F.col("size"), (-F.col("n")).alias("m"))
    kinds = rows.groupBy("root", "demand_type").agg(F.sum("size").alias("_s"), F.min("n").alias("_n")).groupBy("root").agg(F.max_by("demand_type", F.struct("_s", (-F.col("_n")).alias("m"))).alias("demand_type"))
    text = lambda c: F.coalesce(F.max(F.when(F.col(f"merged_{c}") != "", F.col(f"merged_{c}"))), F.max_by(c, largest)).alias(c)
    out = rows.groupBy("root").agg(
        F.count(F.lit(1)).alias("merged_needs"), F.min("demand_tier").alias("demand_tier"), F.max("ai_score").alias("ai_score"), text("title"), text("description"),
        *[F.max_by(c, largest).alias(c) for c in ("category", "ai_intervention_type", "ai_description")], F.max("note").alias("note"),
    )
    return out.join(kinds, "root")


def refined(ledger: Ledger, needs: DataFrame, said: DataFrame, replies: ReplySource, s: Settings) -> DataFrame:
    """Needs with their description rewritten from ``said``, the atoms (root, atom_id, need_statement, weight_signal)."""
    size = said.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    lines = N.numbered_statements(said, ["root"], "need_statement", "weight_signal", "atom_id", s.refine_statements)
    rows = needs.select("root", "title").join(size, "root").join(lines, "root")
    prompts = rows.select(F.col("root").cast("string").alias("id"), N.render_prompt(s.refine, {c: F.col(c) for c in ("title", "size", "statements")}).alias("prompt"))
    new = parsed(ledger.replies("refine", prompts, replies), "description string").select(F.col("id").cast("long").alias("root"), F.col("description").alias("_new"))
    return N.refine_field(needs.join(new, "root", "left"), "description", "_new")


def scored(needs: DataFrame, said: DataFrame) -> DataFrame:
    """Needs with size, the four scores, priority, rank and demand_id."""
    stats = said.groupBy("root").agg(
        F.count(F.lit(1)).alias("size"), F.bround(F.avg("weight_signal"), 2).alias("avg_weight"),
        F.avg(map_value("sentiment", scores.INTENSITY, scores.INTENSITY_UNKNOWN)).alias("heat"),
        F.countDistinct("atom_product").alias("products"), F.countDistinct("source").alias("sources"),
    )
    rows = needs.join(stats, "root")
    imp = scores.importance_score("size", "avg_weight", F.col("heat"), "demand_tier")
    parts = scores.final_scores(imp, scores.ai_relevance_score("ai_score"), scores.commonality_score(F.col("products"), F.col("sources")))
    rows = rows.withColumns(parts).withColumn("priority", scores.priority("tier_ai", tier=F.col("demand_tier"), ai=F.col("ai_score")))
    return R.rank_and_number(rows, "category", [F.desc("final_score"), F.desc("importance_score"), F.desc("ai_relevance_score"), F.desc("size"), F.col("root")])


def consolidate(ledger: Ledger, members: Staged, embed: Embedder, replies: ReplySource, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(needs, evidence) of clustered atoms.

    ``members``: category, cluster_id, atom_id, need_statement, atom_product, source, sentiment, weight_signal, rating, quality_score, source_review_id, pos.
    """
    clusters = ledger.stage("label", lambda m: labelled(ledger, m, replies, s), members, prompt=s.label, statements=s.label_statements)
    groups = ledger.stage("groups", lambda c: candidate_groups(c, embed, s), clusters, similar=s.similar, group=s.group)
    decided = ledger.stage("decide", lambda c, g: merged(ledger, c, g, replies, s), clusters, groups, prompt=s.decide)
    needs = ledger.stage("needs", lambda d, c, m: numbered_needs(needs_of(d, c), d, m), decided, clusters, members)
    roots = ledger.stage("dedupe", lambda n: deduped(ledger, n, replies, s), needs, prompt=s.dedupe, batch=s.batch)

    def atoms_of(n: DataFrame, r: DataFrame, d: DataFrame, m: DataFrame) -> DataFrame:
        # An atom that two outputs of one need name counts once.
        owner = n.select("n", "out_id").join(r.select("n", "root"), "n").join(d.select("out_id", "cluster_id"), "out_id").select("root", "cluster_id").distinct()
        return m.drop("category").join(owner, "cluster_id")

    said = ledger.stage("atoms", atoms_of, needs, roots, decided, members)
    told = ledger.stage("refine", lambda n, r, a: refined(ledger, one_per_root(n, r), a, replies, s), needs, roots, said, prompt=s.refine, statements=s.refine_statements)
    ranked = ledger.stage("score", scored, told, said)
    columns = ["demand_id", "source_review_id", "pos", "source", "weight_signal", "rating", "quality_score", "need_statement", "atom_id"]
    evidence = ledger.stage("evidence", lambda r, a: R.top_evidence(r.select("root", "demand_id").join(a, "root").select(*columns), s.evidence, s.forum), ranked, said, k=s.evidence, forum=s.forum)
    return ranked.rows, evidence.rows


# ---- the registered query: clusters are documents with a vector, replies come from tables that Spark derives -------------

SIMILAR, BATCH = 0.38, 10


def _cluster(n: Column) -> Column:
    return F.concat(F.lit("c"), F.lpad(n.cast("string"), 9, "0"))


def _members(spark: SparkSession, d: str) -> DataFrame:
    has = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    a = atoms(spark, d).join(has, "doc_id")
    return a.select(
        "category", _cluster(F.col("doc_id")).alias("cluster_id"), "atom_id", "need_statement", F.col("product").alias("atom_product"), "source", "sentiment", "weight_signal",
        F.col("weight_signal").cast("int").alias("rating"), (F.col("doc_id") % 9).cast("double").alias("quality_score"), "source_review_id", "pos",
    )


def reply_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Replies of every kind: good ones, broken ones, indices out of range, overlapping groups, and none at all."""
    n = F.col("n")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("n"), "lang")
    label = F.concat(
        F.lit('{"title":"T'), n, F.lit('","description":"D'), n, F.lit('","demand_type":"type '), n % 3, F.lit('","demand_tier":'), n % 3 + 1, F.lit(',"ai_score":'), n % 10 + 1,
        F.lit(',"semantic_fingerprint":"F","is_meaningful":true}'),
    )
    label = F.when(n % 11 == 3, "sorry").when(n % 11 == 4, '{"title":""}').when(n % 11 == 5, F.concat(F.lit("```json\n"), label, F.lit("\n```"))).otherwise(label)
    decide = (
        F.when(n % 4 == 0, "cut off {").when(n % 4 == 1, '{"should_merge":false,"merge_groups":[],"exclude_indices":[]}')
        .when(n % 4 == 2, F.concat(F.lit('{"should_merge":true,"merge_groups":[{"merged_title":"M'), n, F.lit('","cluster_indices":[0,1]}]}')))
        .otherwise(F.concat(F.lit('{"should_merge":true,"merge_groups":[{"merged_title":"M'), n, F.lit('","merged_ai_score":9,"cluster_indices":[1,0]},{"merged_title":"N'), n, F.lit('","cluster_indices":[1,2,77]}],"exclude_indices":[3]}')))
    )
    refine = F.when(n % 3 == 0, F.concat(F.lit('{"description":"R'), n, F.lit('"}'))).when(n % 3 == 1, '{"description":" "}')
    batches = docs.groupBy("lang").agg(F.floor(F.count(F.lit(1)) / BATCH).cast("int").alias("m")).select("lang", F.explode(F.sequence(F.lit(0), F.col("m"))).alias("k"))
    batches = batches.select("lang", "k", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("kind"))
    suggest = F.when(F.col("kind") == "a", F.concat(F.lit('{"merge_groups":[{"indices":[0,2],"merged_title":"A'), F.col("k"), F.lit('","reason":"near"},{"indices":[5,6],"merged_title":"B","reason":"same"},{"indices":[9,50]}]}'))).when(
        F.col("k") % 2 == 0, '{"merge_groups":[{"indices":[3,0],"merged_title":"C","merged_description":"CD","reason":"alike"}]}')
    return {
        "label": docs.select(_cluster(n).alias("id"), label.alias("reply")),
        "decide": docs.select(F.concat(_cluster(n), F.lit("/0")).alias("id"), decide.alias("reply")),
        "dedupe": batches.select(F.concat_ws("/", "lang", F.concat("kind", F.col("k").cast("string"))).alias("id"), suggest.alias("reply")),
        "refine": docs.select((n + 1).cast("string").alias("id"), refine.alias("reply")),
    }


def flow(spark: SparkSession, d: str, root: str) -> tuple[Ledger, DataFrame, DataFrame]:
    vectors = table(spark, d, "embeddings").select(_cluster(F.col("vec_id")).alias("id"), F.col("embedding").alias("vec"))
    ledger = Ledger(spark, root)
    needs, evidence = consolidate(
        ledger, ledger.source(_members(spark, d)), lambda texts: texts.select("id").join(vectors, "id"), from_table(reply_tables(spark, d)), Settings(similar=SIMILAR, batch=BATCH)
    )
    return ledger, needs, evidence


_HEAT = " ".join(f"WHEN '{k}' THEN {v}" for k, v in scores.INTENSITY.items()) + f" ELSE {scores.INTENSITY_UNKNOWN}"
_SQL = f"""
WITH RECURSIVE m AS MATERIALIZED (
  SELECT a.*, CAST(weight_signal AS INTEGER) AS rating, CAST(a.doc_id % 9 AS DOUBLE) AS quality_score FROM ({ATOMS_SQL}) a WHERE a.doc_id IN (SELECT vec_id FROM embeddings)
), lab AS (
  -- Equal prompts have one reply, that of their lowest id; so it is below.
  SELECT category, doc_id, size, min(doc_id) OVER (PARTITION BY category, size, said) AS k
  FROM (SELECT category, doc_id, count(*) AS size, list(need_statement ORDER BY weight_signal DESC, atom_id)[1:8] AS said FROM m GROUP BY category, doc_id)
), c AS MATERIALIZED (
  SELECT category, doc_id, size, 'T' || k AS title, 'D' || k AS description, 'type ' || k % 3 AS demand_type, CAST(k % 3 + 1 AS INTEGER) AS tier, CAST(k % 10 + 1 AS INTEGER) AS ai FROM lab WHERE k % 11 NOT IN (3, 4)
), v AS (SELECT c.category, c.doc_id, CAST(e.embedding AS DOUBLE[]) AS v FROM c JOIN embeddings e ON e.vec_id = c.doc_id),
e AS MATERIALIZED (
  SELECT a.doc_id AS i, b.doc_id AS j FROM v a JOIN v b ON a.category = b.category AND a.doc_id <> b.doc_id WHERE list_cosine_similarity(a.v, b.v) >= {SIMILAR}
), reach(i, j) AS (SELECT i, i FROM e UNION SELECT r.i, e.j FROM reach r JOIN e ON e.i = r.j),
g0 AS (SELECT i AS doc_id, grp, row_number() OVER (PARTITION BY grp ORDER BY i) - 1 AS loc FROM (SELECT i, min(j) AS grp FROM reach GROUP BY i)),
g AS MATERIALIZED (
  SELECT doc_id, grp, loc, k FROM g0 JOIN (SELECT grp, min(grp) OVER (PARTITION BY said) AS k FROM (SELECT grp, list(title ORDER BY loc) AS said FROM g0 JOIN c USING (doc_id) GROUP BY grp)) USING (grp)
), o AS MATERIALIZED (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS out_id, 0 AS ord, NULL AS mtitle, CAST(NULL AS INTEGER) AS mai FROM c WHERE doc_id NOT IN (SELECT doc_id FROM g)
  UNION ALL SELECT doc_id, CAST(doc_id AS VARCHAR), 0, NULL, NULL FROM g WHERE k % 4 IN (0, 1) OR (k % 4 = 2 AND loc > 1) OR (k % 4 = 3 AND loc > 2)
  UNION ALL SELECT doc_id, grp || '/0', loc, 'M' || k, NULL FROM g WHERE k % 4 = 2 AND loc <= 1
  UNION ALL SELECT doc_id, grp || '/0', 1 - loc, 'M' || k, 9 FROM g WHERE k % 4 = 3 AND loc <= 1
  UNION ALL SELECT doc_id, grp || '/1', loc - 1, 'N' || k, NULL FROM g WHERE k % 4 = 3 AND loc BETWEEN 1 AND 2
), d AS MATERIALIZED (
  SELECT out_id, arg_min(c.category, ord) AS category, coalesce(max(mtitle), arg_min(title, ord)) AS title, arg_min(description, ord) AS description, arg_min(demand_type, ord) AS demand_type,
         arg_min(tier, ord) AS tier, coalesce(max(mai), CAST(round_even(avg(ai), 0) AS INTEGER)) AS ai, CAST(sum(size) AS BIGINT) AS size
  FROM o JOIN c USING (doc_id) GROUP BY out_id
), sortable AS (
  SELECT *, CASE WHEN contains(out_id, '/') THEN 'c' || lpad(string_split(out_id, '/')[1], 9, '0') || '/0/' || string_split(out_id, '/')[2] ELSE 'c' || lpad(out_id, 9, '0') END AS okey FROM d
), n AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY category, tier, ai DESC, size DESC, okey) AS n,
         row_number() OVER (PARTITION BY category ORDER BY tier, ai DESC, size DESC, okey) - 1 AS z, count(*) OVER (PARTITION BY category) AS total FROM sortable
), b AS MATERIALIZED (
  SELECT category, 'a' || CAST(z // {BATCH} AS BIGINT) AS batch, z // {BATCH} AS k, z % {BATCH} AS loc, n FROM n
  UNION ALL SELECT category, 'b' || CAST((z - {BATCH // 2}) // {BATCH} AS BIGINT), (z - {BATCH // 2}) // {BATCH}, (z - {BATCH // 2}) % {BATCH}, n FROM n
  WHERE z >= {BATCH // 2} AND least({BATCH}, total - {BATCH // 2} - (z - {BATCH // 2}) // {BATCH} * {BATCH}) >= 2
), s AS MATERIALIZED (
  SELECT x.n AS i, y.n AS j, x.category || '/' || x.batch AS id, t.g, CASE t.g WHEN 0 THEN CASE t.kind WHEN 'a' THEN 'A' || CAST(x.k AS BIGINT) ELSE 'C' END ELSE 'B' END AS mtitle,
         CASE t.kind WHEN 'b' THEN 'CD' END AS mdesc, t.reason
  FROM (VALUES ('a', 0, 0, 2, 'near'), ('a', 1, 5, 6, 'same'), ('b', 0, 3, 0, 'alike')) t(kind, g, p, q, reason)
  JOIN b x ON x.batch[1] = t.kind AND x.loc = t.p JOIN b y ON y.category = x.category AND y.batch = x.batch AND y.loc = t.q
  WHERE t.kind = 'a' OR x.k % 2 = 0
), tied AS (SELECT i, j FROM s UNION SELECT j, i FROM s),
far(i, j) AS (SELECT n, n FROM n UNION SELECT f.i, tied.j FROM far f JOIN tied ON tied.i = f.j),
r AS MATERIALIZED (SELECT i AS n, min(j) AS root FROM far GROUP BY i),
firsts AS (SELECT r.root, s.mtitle, s.mdesc FROM s JOIN r ON r.n = s.i QUALIFY row_number() OVER (PARTITION BY r.root ORDER BY least(s.i, s.j), id, g) = 1),
notes AS (SELECT r.root, string_agg(reason, ' | ' ORDER BY least(s.i, s.j), id, g) AS note FROM s JOIN r ON r.n = s.i GROUP BY r.root),
kinds AS (SELECT root, arg_max(demand_type, [k, -f]) AS demand_type FROM (SELECT root, demand_type, sum(size) AS k, min(n) AS f FROM n JOIN r USING (n) GROUP BY ALL) GROUP BY root),
u AS MATERIALIZED (
  SELECT r.root, count(*) AS merged_needs, min(tier) AS tier, max(ai) AS ai, arg_max(category, [size, -n.n]) AS category, arg_max(title, [size, -n.n]) AS title0, arg_max(description, [size, -n.n]) AS desc0
  FROM n JOIN r ON r.n = n.n GROUP BY r.root
), w AS MATERIALIZED (
  SELECT DISTINCT r.root, o.doc_id FROM n JOIN r ON r.n = n.n JOIN o ON o.out_id = n.out_id
), st AS (
  SELECT root, count(*) AS size, list(need_statement ORDER BY weight_signal DESC, atom_id)[1:6] AS said, round_even(avg(weight_signal), 2) AS w, avg(CASE sentiment {_HEAT} END) AS heat,
         count(DISTINCT product) AS products, count(DISTINCT source) AS sources
  FROM m JOIN w USING (doc_id) GROUP BY root
)
SELECT root, category, category || '_demand_' || CASE WHEN rank < 1000 THEN lpad(CAST(rank AS VARCHAR), 3, '0') ELSE CAST(rank AS VARCHAR) END AS demand_id, merged_needs, title, description, demand_type, demand_tier, ai_score,
       note, size, final_score, CASE WHEN demand_tier = 1 AND ai_score >= 7 THEN 'P0' WHEN demand_tier = 1 OR (demand_tier = 2 AND ai_score >= 6) THEN 'P1' ELSE 'P2' END AS priority, least(reviews, 5) AS shown
FROM (
  SELECT *, CASE WHEN k % 3 = 0 THEN 'R' || k ELSE description0 END AS description, round_even({scores.WEIGHT_IMPORTANCE} * imp + {scores.WEIGHT_AI} * rel + {scores.WEIGHT_COMMONALITY} * com, 2) AS final_score,
         row_number() OVER (PARTITION BY category ORDER BY round_even({scores.WEIGHT_IMPORTANCE} * imp + {scores.WEIGHT_AI} * rel + {scores.WEIGHT_COMMONALITY} * com, 2) DESC, round_even(imp, 2) DESC, round_even(rel, 2) DESC, size DESC, root) AS rank
  FROM (
    SELECT u.root, u.category, u.merged_needs, coalesce(firsts.mtitle, u.title0) AS title, coalesce(firsts.mdesc, u.desc0) AS description0, CAST(min(CAST(u.root AS VARCHAR)) OVER (PARTITION BY coalesce(firsts.mtitle, u.title0), st.size, st.said) AS BIGINT) - 1 AS k,
           kinds.demand_type, u.tier AS demand_tier, u.ai AS ai_score, coalesce(notes.note, '') AS note, CAST(st.size AS BIGINT) AS size,
           greatest(0, least(10, least(ln(1 + st.size) * 1.5, 6) + greatest(0, least(2, (5 - st.w) / 2)) + heat * 1.5 + CASE u.tier WHEN 1 THEN 0.5 WHEN 3 THEN -0.5 ELSE 0 END)) AS imp,
           least(u.ai + CASE WHEN u.ai >= 7 THEN 0.5 ELSE 0 END, 10) AS rel, least(least(ln(1 + st.products) * 3, 7) + (st.sources - 1) * 1.5, 10) AS com,
           (SELECT count(DISTINCT source_review_id) FROM m JOIN w USING (doc_id) WHERE w.root = u.root) AS reviews
    FROM u JOIN st USING (root) JOIN kinds USING (root) LEFT JOIN firsts USING (root) LEFT JOIN notes USING (root)
  )
)
"""


@query("consolidate_needs", "J4 F7 K3 K4 J6 J8 J9 E4 E5 H10 H1", _SQL)
def _consolidate(spark: SparkSession, d: str) -> DataFrame:
    _, needs, evidence = flow(spark, d, scratch_path(spark, "consolidation"))
    shown = evidence.groupBy("demand_id").agg(F.count(F.lit(1)).alias("shown"))
    out = needs.join(shown, "demand_id")
    return out.select(
        "root", "category", "demand_id", "merged_needs", "title", "description", "demand_type", "demand_tier", "ai_score", F.coalesce("note", F.lit("")).alias("note"), "size", "final_score", "priority", "shown",
    )
