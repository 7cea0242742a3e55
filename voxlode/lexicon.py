"""Rule tables.  A lexicon is an ordered list of :class:`Rule`, supplied by the caller.

Rules that yield one value per text are compiled into Column expressions.  Those that yield rows per rule look all words up at once
(``operators/lexicon_scan.py``): tagging needs no join with the rule table and no shuffle, and no row is multiplied before its rules match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of words and patterns that the driver takes; a lexicon is configuration, whatever the number of its rules.
MAX_BYTES = 256 << 20


@dataclass(frozen=True)
class Rule:
    rule_id: str
    label: str = ""
    keywords: Sequence[str] = ()
    patterns: Sequence[str] = ()
    exclude: Sequence[str] = ()
    context: Sequence[str] = ()
    relevance: Sequence[str] = ()
    category: str = ""
    kind: str = ""
    score: int = 0
    attrs: Mapping[str, str] = field(default_factory=dict)


def rules_from_table(lexicon: DataFrame) -> list[Rule]:
    """Read rules from a long table ``(rule_id, ord, label, category, kind, term)``.

    ``kind`` is keyword, pattern, exclude, context or relevance.  Its size is checked before it reaches the driver.
    """
    size = lexicon.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    if size > MAX_BYTES:
        raise ValueError(f"more than {MAX_BYTES} bytes of terms: pass the lexicon in parts")
    rows = (
        lexicon.groupBy("rule_id")
        .agg(
            F.min("ord").alias("ord"),
            F.first("label").alias("label"),
            F.first("category").alias("category"),
            *[
                F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("term")))).alias(k)
                for k in ("keyword", "pattern", "exclude", "context", "relevance")
            ],
        )
        .orderBy("ord", "rule_id")
        .collect()
    )
    return [
        Rule(r.rule_id, r.label or "", r.keyword, r.pattern, r.exclude, r.context, r.relevance, r.category or "")
        for r in rows
    ]
