"""Link-frontier expansion: breadth-first rounds, priorities and host limits."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import col
from docloom.functions.urls import registrable_domain
from docloom.operators.skew import running_row_number
from docloom.session import checkpoint, stored


def breadth_first(
    seeds: DataFrame, edges: DataFrame, max_depth: int = -1, node: str = "url"
) -> DataFrame:
    """(node, depth) of everything reachable; ``max_depth`` below zero means no limit.

    ``edges`` (src, dst) are written once, without repeats.  A round joins only the newest
    frontier, removes what was seen with an anti join, and is checkpointed, so the plan does
    not grow and a lost executor costs one round.
    """
    e = checkpoint(edges.select("src", "dst").distinct())
    found = [checkpoint(seeds.select(F.col(node)).distinct().withColumn("depth", F.lit(0)))]
    visited, frontier, depth = found[0], found[0], 0
    while max_depth < 0 or depth < max_depth:
        depth += 1
        reached = (
            frontier.select(F.col(node).alias("src"))
            .join(e, "src")
            .select(F.col("dst").alias(node))
            .distinct()
            .join(visited.select(node), node, "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = checkpoint(reached)
        if frontier.isEmpty():
            break
        visited = checkpoint(visited.unionByName(frontier)) if depth % 8 == 0 else visited.unionByName(frontier)
    return visited


def merge_frontier(*sources: DataFrame) -> DataFrame:
    """Distinct URLs of all sources with the smallest depth each."""
    u = sources[0]
    for s in sources[1:]:
        u = u.unionByName(s)
    return u.groupBy("url").agg(F.min("depth").alias("depth"))


def by_priority(frontier: DataFrame, seq: str, budget: int) -> DataFrame:
    """Add ``urutan`` (documents first, then arrival) and ``diambil`` (inside the page budget).

    Ranked in two levels over range slices, so one task never sorts the whole frontier.
    """
    one = frontier.withColumn("__one", F.lit(1))
    order = [F.desc("is_document"), F.col(seq)]
    d = running_row_number(one, ["__one"], order, "urutan").drop("__one")
    return d.withColumn("diambil", F.col("urutan") <= budget if budget > 0 else F.lit(True))


def open_hosts(links: DataFrame, host: str, seq: str, max_hosts: int) -> DataFrame:
    """First ``max_hosts`` hosts by arrival: a min per host, then a top-k over hosts."""
    first = links.groupBy(host).agg(F.min(seq).alias("pertama"), F.count("*").alias("tautan"))
    ranked = first.orderBy("pertama", host)
    return ranked.limit(max_hosts) if max_hosts > 0 else ranked


def crawl_within_budget(
    seeds: DataFrame, edges: DataFrame, site_budget: int, run_budget: int = 0, max_depth: int = -1, buckets: int | None = None
) -> DataFrame:
    """(url, site, depth, diambil): breadth-first rounds that stop where the page budget is spent.

    ``seeds`` (url, site); ``edges`` (src, dst, site) with the site of ``dst``.  In each round a site takes new
    addresses in order of address until it has ``site_budget`` pages, and all sites together until
    ``run_budget`` (0: no limit).  Only taken pages are expanded.  Addresses met beyond the budget are in the
    result with ``diambil`` false, at the depth where they were first met.

    What was met is a table hashed by address into buckets once, to which rounds append: a round shuffles its own new
    addresses, never the visited ones.
    """
    spark = seeds.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = stored(edges.select("src", "dst", F.col("site").alias("to")).distinct(), "crawl-edges")
    name, met = f"docloom_visited_{uuid.uuid4().hex}", seeds.select("url", "site").dropDuplicates(["url"])
    pages = spark.createDataFrame([], "site string, n long")
    parts, depth, spent = [], 0, 0
    try:
        while True:
            new = met if depth == 0 else met.join(spark.table(name).select("url"), "url", "left_anti")
            new = stored(new, "crawl-met")
            # ranked in two levels; a hot site is no single task
            ranked = running_row_number(new, ["site"], [F.col("url")], "rn").join(pages, "site", "left")
            ranked = ranked.withColumn("ok", (F.col("rn") + F.coalesce("n", F.lit(0)) <= site_budget) if site_budget > 0 else F.lit(True))
            if run_budget > 0:
                ranked = stored(ranked.withColumn("late", F.when(F.col("ok"), 0).otherwise(1)).withColumn("one", F.lit(1)), "crawl-ranked")
                ranked = running_row_number(ranked, ["one"], [F.col("late"), F.col("url")], "all")
                ranked = ranked.withColumn("ok", F.col("ok") & (F.col("all") + spent <= run_budget))
            done = stored(ranked.select("url", "site", F.lit(depth).alias("depth"), F.col("ok").alias("diambil")), "crawl-round")
            parts.append(done)
            done.select("url").write.bucketBy(n, "url").mode("append").format("parquet").saveAsTable(name)
            taken = done.filter("diambil")
            spent += taken.count()
            pages = checkpoint(pages.unionByName(taken.groupBy("site").agg(F.count("*").alias("n"))).groupBy("site").agg(F.sum("n").alias("n")))
            depth += 1
            met = taken.select(F.col("url").alias("src")).join(e, "src").groupBy(F.col("dst").alias("url")).agg(F.min("to").alias("site"))
            if (0 <= max_depth < depth) or (run_budget > 0 and spent >= run_budget) or met.isEmpty() or done.isEmpty():
                return reduce(DataFrame.unionByName, parts)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def depth_allowed(depth, max_depth: int) -> Column:
    """Whether links of a page at ``depth`` are followed; below zero there is no limit."""
    return F.lit(True) if max_depth < 0 else col(depth) < max_depth


def admit_hosts(links: DataFrame, starts: DataFrame, host: str, seq: str, mode: str = "off", max_hosts: int = 0) -> DataFrame:
    """Add ``boleh`` to links: their host is a start host, or one that ``mode`` opens.

    ``off`` opens no other host, ``family`` those under a registrable domain of a start host, ``all`` every one; of
    these the first ``max_hosts`` by arrival (0: all).  Hosts are settled as one row each and joined back.
    """
    if mode not in ("off", "family", "all"):
        raise ValueError(f"unknown mode {mode}")
    own = starts.select(F.col(host).alias("__own")).distinct()
    others = links.join(own, F.col(host) == F.col("__own"), "left_anti").filter(F.lit(mode != "off") & (F.col(host) != ""))
    if mode == "family":
        domains = own.select(registrable_domain("__own").alias("__dom")).filter("__dom <> ''").distinct()
        others = others.join(domains, registrable_domain(host) == F.col("__dom"), "left_semi")
    opened = open_hosts(others, host, seq, max_hosts).select(F.col(host).alias("__own"))
    known = own.unionByName(opened).distinct()
    return links.join(known, F.col(host) == F.col("__own"), "left").withColumn("boleh", F.col("__own").isNotNull()).drop("__own")
