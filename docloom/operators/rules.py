"""Ordered URL rules: the first rule whose pattern matches, with its capture groups."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import col


def first_rule(url, patterns: list[str]) -> Column:
    """Number (from 1) of the first matching pattern; '' matches all; NULL when none does.

    Rules are configuration, a handful per site, so they become one CASE and no join.
    """
    result = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(patterns, 1))):
        hit = F.lit(True) if p == "" else col(url).rlike(f"(?i){p}")
        result = F.when(hit, F.lit(i)).otherwise(result)
    return result


_GROUP = re.compile(r"\\.|\[(?:\\.|[^\]\\])*\]|(\((?!\?)|\(\?<(?![=!]))", re.S)


def group_count(pattern: str) -> int:
    """Capture groups of a Java pattern: opening brackets that are not escaped, in a class, or special."""
    return sum(m.group(1) is not None for m in _GROUP.finditer(pattern))


def rule_groups(url, patterns: list[str]) -> Column:
    """All capture groups of the first matching rule as array<string>."""
    result = F.array().cast("array<string>")
    for p in reversed(patterns):
        groups = F.array(*[F.regexp_extract(col(url), f"(?i){p}", g) for g in range(1, group_count(p) + 1)])
        hit = F.lit(True) if p == "" else col(url).rlike(f"(?i){p}")
        result = F.when(hit, groups.cast("array<string>")).otherwise(result)
    return result


def find_strictly(wanted: DataFrame, catalog: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Wanted names found in any of the catalog's key columns, case ignored.

    ``ditemukan`` is false for names the catalog lacks; ``require_found`` raises on those.
    """
    known = None
    for k in keys:
        part = catalog.select(F.lower(F.trim(F.col(k).cast("string"))).alias("__k"), F.struct("*").alias("entri"))
        known = part if known is None else known.unionByName(part)
    known = known.groupBy("__k").agg(F.min("entri").alias("entri"))
    w = wanted.withColumn("__k", F.lower(F.trim(name)))
    return w.join(known, "__k", "left").withColumn("ditemukan", F.col("entri").isNotNull()).drop("__k")


def require_found(found: DataFrame, catalog: DataFrame, name: str, key: str) -> DataFrame:
    """``found`` of ``find_strictly`` if all names are known; else an error that lists the known ones.

    Both lists are configuration: the names asked for and one key of each catalog entry.
    """
    missing = [r[0] for r in found.filter(~F.col("ditemukan")).select(name).distinct().orderBy(name).toLocalIterator()]
    if missing:
        known = [str(r[0]) for r in catalog.select(key).distinct().orderBy(key).toLocalIterator()]
        raise ValueError(f"unknown: {', '.join(map(str, missing))}; known: {', '.join(known)}")
    return found
