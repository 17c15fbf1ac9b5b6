"""Registered queries, grouped by what they exercise."""

from __future__ import annotations

import importlib

MODULES = [
    "text_queries", "page_queries", "clean_queries", "chunk_queries", "dedupe_queries", "report_queries",
    "crawl_queries", "flow_queries", "decision_queries", "harvest_queries",
]


def all_queries():
    """The registry with every query module loaded."""
    for m in MODULES:
        importlib.import_module(f"docloom.plans.{m}")
    return importlib.import_module("docloom.plans.registry")
