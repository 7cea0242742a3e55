"""Registered queries."""

from __future__ import annotations

import importlib

from .registry import REGISTRY, Query

MODULES = [
    "demand_report",
    "queries_text",
    "queries_quality",
    "queries_tagging",
    "queries_scores",
    "queries_aggregates",
    "queries_joins",
    "queries_ranking",
    "queries_clustering",
    "queries_enrich",
    "queries_sources",
    "queries_serving",
    "need_mining",
    "consolidation",
]


def load_all() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return REGISTRY
