"""License scans by diagonal voting, with DataFrame functions alone.

A document's words (A-Z in lower case) give a gram of ``WIDTH`` words at each place.  Grams are joined with the grams of license texts by their
hashes; a hit of a document's place and a template's place votes for the diagonal, the difference of both.

* A short template (a phrase, or a notice of a line) is found where one diagonal has the votes of all its grams.
* A long one may have words changed, added or left out: diagonals with ``LEAST_VOTES`` votes that are at most ``GAP`` apart are merged, and the
  span is verified: the hits of the merged diagonals must cover ``SHARE`` of the template's grams within twice the template's length.

Templates are data of the caller; those below are the production table.  Some are marked as base: their places are counted for each
document.  The table of template grams is broadcast; more than ``MOST_GRAMS`` of them are refused.

One scan of the documents writes the hits and one row per document; everything after that moves hits only.  All hits of a document and a template
meet in one group, which is as long as the document.  Rows stay rows: repeated and null ids are judged one by one.  Null and empty
texts have no words.  An empty table gives an empty result.  Hits are verified word by word, so equal hashes can't deceive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

WIDTH, LEAST_VOTES, GAP, SHARE, LONG, MOST_GRAMS = 3, 3, 4, 0.6, 20, 200_000
#: Everything in ASCII but digits and lower-case letters.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words in lower case, parted by one space; ``base`` templates count as places."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def grams(self) -> list[tuple[str, ...]]:
        w = self.words
        return [tuple(w[i : i + WIDTH]) for i in range(len(w) - WIDTH + 1)]

    @property
    def exact(self) -> bool:
        return len(self.words) < LONG


# The phrases of the contract, then public license notices and texts.
TEMPLATES = [
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("gpl", "under the gnu general public license"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license v 2 0"),
    Template("mpl-2", "mozilla public license version 2 0"),
    Template("bsd", "under the bsd license"),
    Template("unlicense", "released into the public domain"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the "
        "software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
        "and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall "
        "be included in all copies or substantial portions of the software",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and "
        "this permission notice appear in all copies",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of "
        "source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    Template(
        "bsd-3",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as "
        "is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations "
        "under the license",
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any "
        "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    ),
]


def text_words(text: Column) -> Column:
    """Words of a text; only A-Z matter for lower case, so the one other letter that becomes an ASCII letter (the Kelvin sign) is masked."""
    low = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u00e9")))
    return F.array_remove(F.split(low, SEPARATOR), "")


def _gram(column) -> Column:
    return F.xxhash64(*(column(k) for k in range(WIDTH)))


def gram_table(spark, templates: list[Template]) -> DataFrame:
    """(template, pos, gram, w0 ...): every place of every template, and a row of its own for the documents."""
    rows = [(i, pos, *g) for i, t in enumerate(templates) for pos, g in enumerate(t.grams)]
    if any(not t.grams for t in templates):
        raise ValueError(f"a template needs {WIDTH} words")
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"more than {MOST_GRAMS} template places")
    names = ", ".join(f"w{k} string" for k in range(WIDTH))
    table = spark.createDataFrame([*rows, (-1, -1, *[None] * WIDTH)], f"template int, pos int, {names}")
    return table.withColumn("gram", F.when(F.col("template") < 0, F.lit(0)).otherwise(_gram(lambda k: F.col(f"w{k}"))))


def hits(df: DataFrame, templates: list[Template], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, n_words, at, template, pos), written once: all hits, and one row with template -1 per document."""
    spark = df.sparkSession
    rows = df.select(df[key].alias("key"), text_words(df[text]).alias("words")).withColumn("row", F.monotonically_increasing_id())
    spread = rows.select("*", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - WIDTH, F.lit(-1)))).alias("at"))
    word = lambda k: F.get("words", F.col("at") + k)
    marked = spread.select("row", "key", "words", "at", F.when(F.col("at") < 0, F.lit(0)).otherwise(_gram(word)).alias("gram"))
    table = gram_table(spark, templates).withColumnRenamed("gram", "template_gram")
    same = (F.col("at") < 0) & (F.col("template") < 0)
    for_words = F.col("at") >= 0
    for k in range(WIDTH):
        for_words = for_words & (word(k) == F.col(f"w{k}"))
    found = marked.join(F.broadcast(table), (F.col("gram") == F.col("template_gram")) & (same | for_words))
    folder = scratch_path(spark, "license-hits")
    found.select("row", "key", F.size("words").cast("long").alias("n_words"), "at", "template", "pos").write.parquet(folder)
    return spark.read.parquet(folder)


def spans(found: DataFrame, templates: list[Template]) -> DataFrame:
    """(row, template, label, base, first_word, last_word, share, verified) of every exact place and every merged span."""
    spark = found.sparkSession
    facts = spark.createDataFrame([(i, t.label, t.base, t.exact, len(t.grams), len(t.words)) for i, t in enumerate(templates)], "template int, label string, base boolean, exact boolean, grams int, length int")
    votes = found.filter("template >= 0").withColumn("diagonal", F.col("at") - F.col("pos"))
    per_diagonal = votes.groupBy("row", "template", "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("at").alias("low"), F.max("at").alias("high")).join(F.broadcast(facts), "template")
    exact = per_diagonal.filter("exact and votes = grams").select(
        "row", "template", "label", "base", F.col("low").cast("long").alias("first_word"), (F.col("high") + WIDTH - 1).cast("long").alias("last_word"), F.lit(1.0).alias("share"), F.lit(True).alias("verified")
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    strong = per_diagonal.filter(f"not exact and votes >= {LEAST_VOTES}").withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(order) > GAP).cast("int"))
    strong = strong.withColumn("group", F.sum(F.coalesce("apart", F.lit(0))).over(order)).select("row", "template", "diagonal", "group", "label", "base", "grams", "length")
    merged = votes.join(strong, ["row", "template", "diagonal"]).groupBy("row", "template", "group", "label", "base", "grams", "length").agg(
        F.count_distinct("pos").alias("covered"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    share = F.col("covered") / F.col("grams")
    long_ = merged.select(
        "row", "template", "label", "base", F.col("low").cast("long").alias("first_word"), (F.col("high") + WIDTH - 1).cast("long").alias("last_word"), share.alias("share"),
        ((share >= SHARE) & (F.col("high") - F.col("low") + WIDTH <= 2 * F.col("length"))).alias("verified"),
    )
    return exact.unionByName(long_)


def scan(df: DataFrame, templates: list[Template] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    score: the largest share of a template that was found, 1 where a short one stands.
    """
    templates = templates or TEMPLATES
    found = hits(df, templates, key, text)
    base = F.col("base") & F.col("verified")
    named = lambda on: F.array_join(F.sort_array(F.collect_set(F.when(on, F.col("label")))), ",")
    judged = spans(found, templates).groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"), F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        named(base).alias("base_labels"), named(F.col("verified")).alias("labels"), F.max("share").alias("score"),
    )
    docs = found.filter("template < 0").select("row", F.col("key").alias(key), "n_words")
    none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return docs.join(judged, "row", "left").na.fill(none, list(none)).select(key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def oracle(templates: list[Template]) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    grams = ", ".join(f"({i}, {p}, {', '.join(map(quoted, g))})" for i, t in enumerate(templates) for p, g in enumerate(t.grams))
    facts = ", ".join(f"({i}, {quoted(t.label)}, {t.base}, {t.exact}, {len(t.grams)}, {len(t.words)})" for i, t in enumerate(templates))
    return f"""
WITH g(template, pos, a, b, c) AS (VALUES {grams}),
f(template, label, base, exact, grams, length) AS (VALUES {facts}),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), p AS (SELECT r, i AS i0, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT r, w, unnest(range(len(w) - 2)) AS i FROM d)),
h AS MATERIALIZED (SELECT r, template, i0, pos, i0 - pos AS diagonal FROM p JOIN g USING (a, b, c)),
v AS (SELECT r, template, diagonal, count(*) AS votes, min(i0) AS low FROM h GROUP BY ALL),
s AS (
  SELECT r, template, diagonal, coalesce(CAST(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {GAP} AS INTEGER), 0) AS apart
  FROM v JOIN f USING (template) WHERE NOT exact AND votes >= {LEAST_VOTES}
), m AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS part FROM s),
x AS (
  SELECT r, label, base, low AS first_word, 1.0::DOUBLE AS share, true AS verified FROM v JOIN f USING (template) WHERE exact AND votes = grams
  UNION ALL
  SELECT r, label, base, low, covered / grams, covered / grams >= {SHARE} AND high - low + {WIDTH} <= 2 * length
  FROM (SELECT r, template, part, count(DISTINCT pos) AS covered, min(i0) AS low, max(i0) AS high FROM h JOIN m USING (r, template, diagonal) GROUP BY ALL) JOIN f USING (template)
), j AS (
  SELECT r, count(*) FILTER (base AND verified) AS n_base, min(first_word) FILTER (base AND verified) AS first_word, max(first_word) FILTER (base AND verified) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND verified) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (verified) AS labels, max(share) AS score
  FROM x GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN j USING (r)
"""


ORACLE = oracle(TEMPLATES)
