"""Helpers shared by the training-data operators: tables, staging, Arrow row work, components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import checkpoint, stored  # noqa: F401  (stored is used by the operators)

#: The white space that ends a word in every contract of this package.
SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, _UPPER, _LOWER)


def words(c: Column) -> Column:
    """The words of a text as an array; no words for null."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE), "")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased; ``bytes.split`` cuts at exactly the six ASCII spaces."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long ids): rows ``node, root`` with the least id reachable.

    Alternates the two star operations of the two-phase algorithm (large star, small star) until
    nothing changes: O(log n) rounds, each a grouped minimum and a join, checkpointed.  A minimum is
    combined before the shuffle and the join splits skewed keys, so a hub costs no single task.
    Loops and repeated edges are harmless; an empty input gives an empty result.
    """
    e = checkpoint(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u meets the least of u's neighbourhood
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours meet their least
        down = large.filter("u > v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v")
            .filter("u > v")
            .distinct()
        )
        new = checkpoint(small)
        same = new.join(e, ["u", "v"], "left_anti").limit(1).count() == 0 and new.count() == e.count()
        e = new
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
