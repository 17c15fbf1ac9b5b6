"""All queries of this package."""

from __future__ import annotations

import importlib

MODULES = [
    "suffix_tree", "simhash", "toxicity", "line_dedup", "quality_rules", "language_id", "decontamination", "mixing",
    "license_scan", "html_blocks", "source_divergence", "substring_dedup", "collocations",
]


def all_queries():
    """The registry with every operator module loaded."""
    for m in MODULES:
        importlib.import_module(f"docloom.llm.{m}")
    return importlib.import_module("docloom.llm.registry")
