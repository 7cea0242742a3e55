"""Read-side queries over served opportunities.

Expected columns: id, category, title, description, user_voice, apps (array), ai_keywords (array), demand_type,
ai_intervention_type, mention_count, final_score, product_breakdown and source_breakdown (maps), and
evidence as array<struct<..., date, app_name, channel>>.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import product_coverage
from ..functions.text import col


def list_needs(served: DataFrame, category: str | None = None, products: str = "product_breakdown") -> DataFrame:
    """Opportunities of a category without those spread thinly over many products."""
    rows = served if category is None else served.filter(F.col("category") == category)
    c = product_coverage(products)
    return rows.withColumn("_c", c).filter(~F.col("_c.dirty")).withColumn("is_cross_product", F.col("_c.cross_product")).drop("_c")


def search(needs: DataFrame, keyword: str, texts: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Rows with the keyword in any text or array column, ignoring case.  A blank keyword keeps all."""
    k = keyword.strip().lower()
    if not k:
        return needs
    hay = F.concat_ws(" ", *[F.coalesce(F.col(t), F.lit("")) for t in texts], *[F.array_join(a, " ") for a in arrays])
    return needs.filter(F.lower(hay).contains(k))


def filter_facets(
    needs: DataFrame, sources: Sequence[str] = (), types: Sequence[str] = (), only_cross: bool = False, breakdown: str = "source_breakdown"
) -> DataFrame:
    """Any of the sources with a count, type in set, cross-product only; an empty set means all."""
    out = needs
    if sources:
        hit = F.lit(False)
        for s in sources:
            hit = hit | (F.coalesce(F.try_element_at(breakdown, F.lit(s)), F.lit(0)) > 0)
        out = out.filter(hit)
    if types:
        out = out.filter(F.coalesce("demand_type", F.lit("")).isin(list(types)))
    return out.filter("is_cross_product") if only_cross else out


def latest_evidence(evidence: Column | str = "evidence") -> Column:
    return F.array_max(F.transform(col(evidence), lambda e: e["date"]))


def sort_page(needs: DataFrame, mode: str, shown: int = 5, more: int = 0) -> DataFrame:
    """The first ``shown + 5 * more`` rows by latest evidence date, mentions or score; ties by id."""
    key = {"recent": latest_evidence(), "mentions": F.col("mention_count"), "score": F.col("final_score")}[mode]
    return needs.orderBy(key.desc_nulls_last(), "id").limit(shown + 5 * more)


def filter_by_attribute(
    served: DataFrame, intervention: str | None = None, cross_category: str | None = None, row_id: str | None = None
) -> DataFrame:
    """By intervention type, by a non-empty array column of related categories, or by id."""
    out = served
    if intervention is not None:
        out = out.filter(F.col("ai_intervention_type") == intervention)
    if cross_category is not None:
        out = out.filter(F.size(cross_category) > 0)
    if row_id is not None:
        out = out.filter(F.col("id") == row_id)
    return out


def counts_of(names: Column) -> Column:
    """Array of struct(name, n) by descending count of an array of names, ties by first place."""
    return F.transform(
        F.array_sort(
            F.transform(
                F.array_distinct(names),
                lambda x: F.struct(
                    (-F.size(F.filter(names, lambda y: y == x))).alias("neg"), F.array_position(names, x).alias("at"), x.alias("name")
                ),
            )
        ),
        lambda e: F.struct(e["name"].alias("name"), (-e["neg"]).alias("n")),
    )


def product_names(breakdown: Column | str, evidence_apps: Column, max_chars: int = 30) -> Column:
    """Products by descending count without long or colon names; from the evidence if none is left."""
    entries = F.array_sort(
        F.transform(F.map_entries(col(breakdown)), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k")))
    )
    named = F.filter(
        F.transform(entries, lambda e: e["k"]), lambda k: (F.length(k) > 0) & (F.length(k) <= max_chars) & ~k.contains(":")
    )
    fallback = F.transform(
        counts_of(F.filter(evidence_apps, lambda a: (F.length(a) > 0) & (F.length(a) <= max_chars))), lambda e: e["name"]
    )
    return F.when(F.size(named) > 0, named).otherwise(fallback)


def need_view(needs: DataFrame, references: str = "references") -> DataFrame:
    """Served row: channel counts, product names, up to four keywords, and the chosen references.

    Channels are counted over the evidence unless the needs bring their ``mention_sources`` along.
    """
    channels = F.transform("evidence", lambda e: e["channel"])
    apps = F.transform("evidence", lambda e: e["app_name"])
    keep = [c for c in ("id", "category", "title", "description", "demand_type", "mention_count", "is_cross_product", references) if c in needs.columns]
    return needs.select(
        *keep,
        product_names("product_breakdown", apps).alias("apps"),
        F.slice(F.coalesce("ai_keywords", F.array().cast("array<string>")), 1, 4).alias("keywords"),
        (F.col("mention_sources") if "mention_sources" in needs.columns else counts_of(channels)).alias("mention_sources"),
    )
