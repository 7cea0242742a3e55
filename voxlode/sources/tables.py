"""Bindings of the given Parquet tables to the feedback shapes used by the operators.

Every binding has a Spark form and the same definition as SQL text, so that an oracle
can start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str, rated: bool = True, **made: Column) -> DataFrame:
    """Store-like reviews: one row per document; with ``rated`` the rating from the quality label, which costs a join.

    ``made`` are further columns, taken from the documents before any join: what is made from the text so needs no text behind it.
    """
    docs = table(spark, sf_dir, "documents").withColumns(made)
    n = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (n % 366).cast("int")), "yyyy-MM-dd")
    clock = F.when(n % 3 == 0, "T23:30:00-07:00").when(n % 3 == 1, "T08:15:00Z").otherwise("")
    rating = F.when(F.col("quality") == 1, 5 - n % 2).when(F.col("quality") == 0, 1 + n % 2).otherwise(1 + n % 5).cast("int")
    if rated:
        docs = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return docs.select(
        F.concat(F.lit("doc_"), n.cast("string")).alias("id"),
        n,
        F.col("text").alias("content"),
        F.col("source").alias("app_name"),
        F.col("lang").alias("category"),
        *([rating.alias("rating")] if rated else []),
        F.concat(F.lit("u"), (n % 97).cast("string")).alias("author"),
        F.concat(day, clock).alias("date"),
        F.when(n % 3 == 0, "store").when(n % 3 == 1, "play").otherwise("forum").alias("channel"),
        *made,
    )


REVIEWS_SQL = """
SELECT 'doc_' || CAST(d.doc_id AS VARCHAR) AS id, d.doc_id AS doc_id, d.text AS content,
       d.source AS app_name, d.lang AS category,
       CAST(CASE WHEN l.quality = 1 THEN 5 - d.doc_id % 2
                 WHEN l.quality = 0 THEN 1 + d.doc_id % 2
                 ELSE 1 + d.doc_id % 5 END AS INTEGER) AS rating,
       'u' || CAST(d.doc_id % 97 AS VARCHAR) AS author,
       strftime(DATE '2024-01-01' + CAST(d.doc_id % 366 AS INTEGER), '%Y-%m-%d')
         || CASE d.doc_id % 3 WHEN 0 THEN 'T23:30:00-07:00' WHEN 1 THEN 'T08:15:00Z' ELSE '' END AS date,
       CASE d.doc_id % 3 WHEN 0 THEN 'store' WHEN 1 THEN 'play' ELSE 'forum' END AS channel
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum-like comments: the user turns, titled by the start of their conversation."""
    turns = table(spark, sf_dir, "conversations")
    titles = turns.filter("turn = 0").select("conv_id", F.substring("text", 1, 40).alias("story_title"))
    n = F.col("conv_id")
    return turns.filter("role = 'user'").join(titles, "conv_id", "left").select(
        (n * 1000 + F.col("turn")).alias("id"),
        F.col("text").alias("content"),
        F.coalesce("story_title", F.lit("")).alias("story_title"),
        (F.length("text") % 120).cast("int").alias("points"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (n % 366).cast("int")), "yyyy-MM-dd").alias("date"),
        F.when(n % 4 == 0, "chat").when(n % 4 == 1, "work").when(n % 4 == 2, "media").otherwise("tools").alias("category"),
    )


COMMENTS_SQL = """
SELECT c.conv_id * 1000 + c.turn AS id, c.text AS content,
       coalesce(substr(t.text, 1, 40), '') AS story_title,
       CAST(length(c.text) % 120 AS INTEGER) AS points,
       strftime(DATE '2024-01-01' + CAST(c.conv_id % 366 AS INTEGER), '%Y-%m-%d') AS date,
       CASE c.conv_id % 4 WHEN 0 THEN 'chat' WHEN 1 THEN 'work' WHEN 2 THEN 'media' ELSE 'tools' END AS category
FROM conversations c LEFT JOIN (SELECT conv_id, text FROM conversations WHERE turn = 0) t
  ON c.conv_id = t.conv_id
WHERE c.role = 'user'
"""


def atoms(spark: SparkSession, sf_dir: str, statements: bool = True) -> DataFrame:
    """Need atoms: one per line of every document.

    Without ``statements`` the lines are only counted, and no text takes part in the joins.
    """
    label = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("_label"))
    lines = lambda c: F.filter(F.split(c, "\n"), lambda s: F.length(s) > 0)
    src = reviews(spark, sf_dir) if statements else reviews(spark, sf_dir, n_lines=F.size(lines("text")))
    src = src.join(label, "doc_id", "left").withColumn("label", F.coalesce("_label", F.col("doc_id") % 10))
    if statements:
        each = src.withColumn("line", lines("content")).select("*", F.posexplode("line").alias("pos", "need_statement"))
    else:
        each = src.drop("content").filter("n_lines > 0").withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("n_lines") - 1)))
    return (
        each.select(
            F.concat("id", F.lit("_a"), (F.col("pos") + 1).cast("string")).alias("atom_id"),
            F.col("id").alias("source_review_id"),
            "doc_id",
            F.col("pos").cast("int").alias("pos"),
            F.col("channel").alias("source"),
            F.col("app_name").alias("source_product"),
            F.substring("date", 1, 10).alias("source_date"),
            F.col("rating").cast("double").alias("weight_signal"),
            F.when(F.col("channel") == "forum", "tech").otherwise("consumer").alias("perspective"),
            *(["need_statement"] if statements else []),
            F.col("app_name").alias("product"),
            F.element_at(
                F.array(*[F.lit(s) for s in SENTIMENTS]), (F.col("label") % 5 + 1).cast("int")
            ).alias("sentiment"),
            F.element_at(F.array(*[F.lit(s) for s in NEED_TYPES]), (F.col("label") % 3 + 1).cast("int")).alias("type"),
            F.col("label").cast("int").alias("label"),
            "category",
        )
    )


SENTIMENTS = ["angry", "frustrated", "disappointed", "neutral", "suggesting"]
NEED_TYPES = ["feature", "problem", "policy"]

ATOMS_SQL = f"""
SELECT id || '_a' || CAST(pos + 1 AS VARCHAR) AS atom_id, id AS source_review_id, doc_id,
       CAST(pos AS INTEGER) AS pos, channel AS source, app_name AS source_product,
       substr(date, 1, 10) AS source_date, CAST(rating AS DOUBLE) AS weight_signal,
       CASE WHEN channel = 'forum' THEN 'tech' ELSE 'consumer' END AS perspective,
       lines[pos + 1] AS need_statement, app_name AS product,
       {SENTIMENTS}[label % 5 + 1] AS sentiment, {NEED_TYPES}[label % 3 + 1] AS type,
       CAST(label AS INTEGER) AS label, category
FROM (
  SELECT *, unnest(range(len(lines))) AS pos
  FROM (
    SELECT r.*, coalesce(e.label, r.doc_id % 10) AS label, [s for s in string_split(r.content, chr(10)) if length(s) > 0] AS lines
    FROM ({REVIEWS_SQL}) r LEFT JOIN embeddings e ON e.vec_id = r.doc_id
  ) a
) b
"""
