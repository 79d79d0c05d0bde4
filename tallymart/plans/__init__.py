"""Named queries over the given tables, one module per family."""

from __future__ import annotations

import importlib

FAMILIES = [
    "source_queries",
    "relational_queries",
    "retail_queries",
    "neighbour_queries",
    "factor_queries",
    "statistics_queries",
    "classification_queries",
    "text_queries",
    "series_queries",
    "cluster_queries",
]


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"tallymart.plans.{family}")
