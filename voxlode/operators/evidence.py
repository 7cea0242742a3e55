"""Choosing evidence texts for demands."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.quality import QualityRules, SampleRules, passes_rules, sample_quality_of
from ..functions.scores import blend_score
from ..lexicon import MAX_BYTES, Rule
from .lexicon_scan import Found, lookup, scan

Demand = tuple[str, str, Sequence[str]]


def demands_from_table(demands: DataFrame) -> list[Demand]:
    """Demands of a table (demand_id, title, keywords array<string>), by id; its size is checked before it reaches the driver."""
    size = demands.agg(F.coalesce(F.sum(F.octet_length("title") + F.octet_length(F.array_join("keywords", ""))), F.lit(0))).first()[0]
    if size > MAX_BYTES:
        raise ValueError(f"more than {MAX_BYTES} bytes of demands: pass them in parts")
    rows = demands.select("demand_id", "title", "keywords").orderBy("demand_id").collect()
    return [(r.demand_id, r.title or "", list(r.keywords or [])) for r in rows]


def rated_for_demands(
    rows: DataFrame,
    text: str,
    demands: Sequence[Demand],
    title_terms: Callable[[str], list[str]],
    rules: QualityRules,
    sample: SampleRules,
    min_quality: float = 2.0,
) -> DataFrame:
    """Rows times the demands they are relevant to, with ``quality``, ``relevance`` and ``blend``.

    The words of all demands are looked up at once, whatever their number; a text meets a demand only when one of the demand's words occurs
    in it.  What holds for a text alone is judged once, and only where some demand is met.
    """
    lexicon = [Rule(d, keywords=[*title_terms(t), *kw], relevance=title_terms(t), context=kw) for d, t, kw in demands]
    ids = np.array([r.rule_id for r in lexicon], object)

    def judge(found: Found, batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, list[pa.Array]]:
        code, n, _ = found.codes("keywords")
        of = code // found.lexicon.n
        related = sum(lookup(*found.codes(role)[:2], code) for role in ("relevance", "context"))
        at, start = np.unique(of, return_index=True)
        edge = pa.array(np.append(start, len(code)), pa.int32())
        lists = [pa.array(ids[code % found.lexicon.n + first], pa.string()), pa.array(n, pa.int32()), pa.array(related, pa.int32())]
        return at, [pa.ListArray.from_arrays(edge, x) for x in lists]

    met = scan(rows, F.lower(F.col(text)), lexicon, "_demands array<string>, _relevance array<int>, _related array<int>", judge)
    judged = met.withColumn("_gate", passes_rules(text, rules))
    each = judged.select(*rows.columns, "_gate", F.inline(F.arrays_zip(F.col("_demands").alias("demand_id"), F.col("_relevance").alias("relevance"), F.col("_related").alias("_words"))))
    out = each.withColumn("quality", sample_quality_of(text, F.col("_gate"), F.col("_words"), rules, sample)).filter(F.col("quality") > min_quality)
    return out.select(*rows.columns, "demand_id", "relevance", "quality").withColumn("blend", blend_score(F.col("quality"), F.col("relevance")))


def best_for_demands(rated: DataFrame, row_id: str, k: int = 5) -> DataFrame:
    """The ``k`` best rows per demand by blend, ties by row id; adds ``rank``."""
    w = W.partitionBy("demand_id").orderBy(F.desc("blend"), row_id)
    return rated.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
