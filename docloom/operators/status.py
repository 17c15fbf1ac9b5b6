"""Crawl status table: upsert, insert-ignore, histogram, site skipping, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K

UPDATED = ["status", "message", "run_id", "last_crawled"]


def _one_per_key(df: DataFrame, key: str, order: str, last: bool) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    pick = F.max_by if last else F.min_by
    return df.groupBy(key).agg(pick(F.struct(*rest), order).alias("__r")).select(
        key, *[F.col(f"__r.{c}").alias(c) for c in rest]
    )


def upsert_status(existing: DataFrame, updates: DataFrame, order: str) -> DataFrame:
    """Rows after recording ``updates``: new URLs inserted, known ones change four columns only.

    An inserted URL keeps the descriptive columns of its first update and the status of its
    last.  Both picks are aggregates that combine before the shuffle.
    """
    fixed = [c for c in existing.columns if c not in UPDATED + ["url"]]
    u = updates.withColumn(
        "status", F.when(F.col("status").isin(K.SITE_STATUSES), F.col("status")).otherwise("success")
    ).withColumn("message", F.substring("message", 1, 250))
    last = u.groupBy("url").agg(
        F.max_by(F.struct(*UPDATED), order).alias("new"),
        F.min_by(F.struct(*fixed), order).alias("base"),
    )
    e = existing.select("url", F.struct(*UPDATED).alias("old"), F.struct(*fixed).alias("kept"))
    j = e.join(last, "url", "full_outer")
    return j.select(
        "url",
        *[F.coalesce(F.col(f"kept.{c}"), F.when(F.col("kept").isNull(), F.col(f"base.{c}"))).alias(c) for c in fixed],
        *[F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in UPDATED],
    )


def insert_ignore(existing: DataFrame, discovered: DataFrame, order: str) -> DataFrame:
    """Existing rows untouched, plus the first row of every unknown URL as ``discovered``."""
    new = _one_per_key(discovered, "url", order, last=False).join(existing, "url", "left_anti")
    new = new.withColumn("status", F.lit("discovered")).withColumn("run_id", F.lit(""))
    return existing.unionByName(new.select(*existing.columns))


def status_histogram(sites: DataFrame) -> DataFrame:
    """One row: a count per known status (0 when absent) and the total."""
    return sites.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in K.SITE_STATUSES],
        F.count("*").alias("total"),
    )


def latest(sites: DataFrame, status: str = "", limit: int = 200) -> DataFrame:
    d = sites.filter(F.col("status") == status) if status else sites
    return d.orderBy(F.desc("last_crawled"), F.desc("id")).limit(max(1, min(2000, limit)))


def skip_finished_sites(sites: DataFrame, history: DataFrame, key: str, start_urls: str) -> DataFrame:
    """Sites with at least one start URL that never succeeded (or with no start URL)."""
    done = history.filter(F.col("status") == "success").select("url").distinct()
    urls = sites.select(key, F.explode(start_urls).alias("url")).distinct()
    open_urls = urls.join(done, "url", "left_anti").select(key).distinct()
    seedless = F.coalesce(F.size(start_urls), F.lit(0)) <= 0
    return sites.join(open_urls.withColumn("__open", F.lit(True)), key, "left").filter(
        seedless | F.col("__open")
    ).drop("__open")


def site_outcome(processed, failed) -> Column:
    return F.when((processed > 0) & (processed == failed), F.lit("failed_akses")).otherwise("success")


def run_status(fetch_failed, parse_failed, fetched) -> Column:
    return (
        F.when((fetch_failed == 0) & (parse_failed == 0), F.lit("SUKSES"))
        .when(fetched > 0, F.lit("SUKSES_SEBAGIAN"))
        .otherwise(F.lit("GAGAL"))
    )

