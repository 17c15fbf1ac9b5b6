"""Recover the addresses of stored documents and plan their processing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import urls as U
from docloom.functions.ids import hash8

PRIORITY = {"url": 0, "markdown": 1, "html": 2}


def candidates(urls: DataFrame) -> DataFrame:
    """(hash8, url, sumber): one address per hash prefix.

    ``urls`` has url, sumber, seq.  Each URL counts as written and in normalised form; the most
    trusted source and the earliest mention win, as an aggregate and not a window.
    """
    d = urls.select("sumber", "seq", F.trim("url").alias("url")).filter(F.col("url") != "")
    d = U.with_normalized_url(d, "url", "url", "__n")
    d = d.select(
        "sumber", "seq", F.posexplode(F.array_distinct(F.array_compact(F.array("url", "__n")))).alias("form", "url")
    )
    rank = F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])[F.col("sumber")]
    first = F.struct(F.coalesce(rank, F.lit(3)), "seq", "form")
    return d.groupBy(hash8("url").alias("hash8")).agg(
        F.min_by(F.struct("url", "sumber"), first).alias("c")
    ).select("hash8", "c.url", "c.sumber")


def match_files(files: DataFrame, cands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with their address, files without one); the key is the hash in the file name."""
    f = files.withColumn("hash8", U.hash8_from_file_name("nama"))
    return f.join(cands, "hash8"), f.join(cands, "hash8", "left_anti")


def plan_items(items: DataFrame, limit: int = 0) -> DataFrame:
    """Processing order: source trust, then file name; first ``limit`` only when it is set."""
    rank = F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])[F.col("sumber")]
    d = items.withColumn("prioritas", F.coalesce(rank, F.lit(3))).orderBy("prioritas", "nama")
    return d.limit(limit) if limit > 0 else d


def not_yet_processed(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")
