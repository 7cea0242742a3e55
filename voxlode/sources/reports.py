"""Ranked text reports: writing, and reading them back into records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import trim_all, truncate
from ..operators.ranking import top_k


@dataclass(frozen=True)
class ReportFormat:
    """Words and signs of a report."""

    section_open: str = "== "
    section_close: str = " =="
    mentions: str = "mentions: "
    mentions_unit: str = ""
    ai: str = "AI score: "
    quote_open: str = "“"
    quote_close: str = "”"
    stars_unit: str = ""


DEFAULT = ReportFormat()
# Signs of the Chinese report layout.
CHINESE = ReportFormat("【", "】", "提及: ", "条", "AI介入分: ", "「", "」", "星")


def star_bar(rating: Column) -> Column:
    r = F.greatest(F.least(rating.cast("int"), F.lit(5)), F.lit(0))
    return F.concat(F.repeat(F.lit("★"), r), F.repeat(F.lit("☆"), 5 - r))


def report_lines(
    stats: DataFrame, samples: DataFrame, demand: str, text: str, rating: str, order: Sequence[Column], fmt: ReportFormat = DEFAULT, quotes: int = 3, chars: int = 250
) -> DataFrame:
    """Lines of a ranked report: (rank, part, line), to be read in that order.

    ``stats``: demand, section, title, mentions, ai_score, direction and ``rank`` (running over
    sections).  ``samples``: demand, text, rating; the first ``quotes`` in ``order`` are quoted.
    """
    w = W.partitionBy("section").orderBy("rank")
    s = stats.withColumn("_first", F.row_number().over(w) == 1)
    q = lambda c: c.cast("string")
    head = F.when(F.col("_first"), F.concat(F.lit(fmt.section_open), F.col("section"), F.lit(fmt.section_close)))
    title = F.concat(F.lit("#"), q(F.col("rank")), F.lit(" "), F.col("title"))
    metric = F.concat(
        F.lit("    " + fmt.mentions), q(F.col("mentions")), F.lit(fmt.mentions_unit + " | " + fmt.ai), q(F.col("ai_score")), F.lit("/10 | "), F.col("direction")
    )
    lines = F.array(*[F.struct(F.lit(i).alias("part"), x.alias("line")) for i, x in enumerate((head, title, metric))])
    top = s.select("rank", F.inline(lines)).filter("line is not null")
    best = top_k(samples, [demand], list(order), quotes, "_r").join(s.select(demand, "rank"), demand)
    stars = F.concat(F.lit("  ["), q(F.col("_r")), F.lit("] "), star_bar(F.col(rating)), F.lit(" ("), q(F.col(rating)), F.lit(fmt.stars_unit + ")"))
    said = F.concat(F.lit("      " + fmt.quote_open), truncate(trim_all(F.col(text)), chars), F.lit(fmt.quote_close))
    pair = F.array(
        F.struct((F.col("_r") * 2 + 1).alias("part"), stars.alias("line")), F.struct((F.col("_r") * 2 + 2).alias("part"), said.alias("line"))
    )
    return top.unionByName(best.select("rank", F.inline(pair)))


def write_report(lines: DataFrame, path: str) -> None:
    """One text file.  A report has a few lines per rule, so its size is that of the lexicon."""
    lines.repartition(1).sortWithinPartitions("rank", "part").select(F.col("line").alias("value")).write.text(path)


def parse_ranked_report(spark: SparkSession, path: str | Sequence[str], fmt: ReportFormat = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(demands, samples) of text reports.

    Section headers are carried forward, titles open a record, the metrics line fills it, and a
    star line takes the quoted text within the next four lines.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = raw.select("file", F.posexplode(F.split("value", "\n")).alias("n", "line")).withColumn("line", F.trim("line"))
    e = lambda x: re.escape(x.strip())
    first = lambda p, g=1: F.when(F.col("line").rlike(p), F.regexp_extract("line", p, g))
    w = W.partitionBy("file").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    section = f"^{e(fmt.section_open)}\\s*(.+?)\\s*{e(fmt.section_close)}$"
    title = r"^#\d+\s+(.+)$"
    base = lines.withColumns({"_sec": first(section), "_title": first(title)})
    base = base.withColumns(
        {
            "section": F.last("_sec", ignorenulls=True).over(w),
            "rec": F.last(F.when(F.col("_title").isNotNull(), F.col("n")), ignorenulls=True).over(w),
        }
    )
    m = f"{e(fmt.mentions)}\\s*(\\d+)"
    a = f"{e(fmt.ai)}\\s*(\\d+)/10"
    metric = F.col("line").rlike(m) & F.col("line").rlike(a)
    parts = F.split("line", r"\|")
    direction = F.when(metric & (F.size(parts) >= 3), F.trim(F.element_at(parts, -1)))
    rec = base.filter("rec is not null")
    demands = (
        rec.groupBy("file", "rec")
        .agg(
            F.first("section").alias("section"),
            F.max("_title").alias("title"),
            F.max(F.when(metric, F.regexp_extract("line", m, 1).cast("int"))).alias("mention_count"),
            F.max(F.when(metric, F.regexp_extract("line", a, 1).cast("int"))).alias("ai_score"),
            F.max(direction).alias("direction"),
        )
        .filter("coalesce(title, '') <> '' and mention_count > 0")
        .withColumn("keywords", F.filter(F.transform(F.split(F.coalesce("direction", F.lit("")), "[、,，]"), F.trim), lambda x: x != ""))
    )
    quote = f"{e(fmt.quote_open)}(.+?){e(fmt.quote_close)}"
    star = r"^\[(\d+)\]\s*[★☆]+\s*\((\d+)"
    by_line = W.partitionBy("file", "rec").orderBy("n")
    after = F.coalesce(*[F.when(F.lead("line", k).over(by_line).rlike(quote), F.regexp_extract(F.lead("line", k).over(by_line), quote, 1)) for k in range(1, 5)])
    samples = (
        rec.withColumn("content", after)
        .filter(F.col("line").rlike(star) & F.col("content").isNotNull())
        .select("file", "rec", F.regexp_extract("line", star, 1).cast("int").alias("idx"), F.regexp_extract("line", star, 2).cast("int").alias("rating"), "content")
    )
    return demands, samples.join(demands.select("file", "rec", "title"), ["file", "rec"])
