"""Documents named by answers of a site's services: bases of relative files, folders, and their way into the frontier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import urls as U
from docloom.functions.text import col
from docloom.operators.links import check_robots
from docloom.session import checkpoint

#: Folders below a host in which sites keep their files, in the order they are tried.
FILE_FOLDERS = ["", "/uploads", "/storage"]


def first_segment(path) -> Column:
    """First part of a relative path; files of one part share their base."""
    return F.get(F.split(F.ltrim(col(path), F.lit("/")), "/"), F.lit(0))


def base_candidates(api_url, page_url) -> Column:
    """Possible bases in order: folders of the service's host, then of the page's host, each once."""
    origins = F.filter(F.array(U.origin(api_url), U.origin(page_url)), lambda o: o != "")
    return F.array_distinct(F.flatten(F.transform(origins, lambda o: F.array(*[F.concat(o, F.lit(f)) for f in FILE_FOLDERS]))))


def resolve_bases(files: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Add ``base`` and ``suara`` to ``files`` (key, path, api_url, page_url): one base for each first segment of a key.

    A candidate gets a vote for each of the segment's paths whose joined address is among ``known`` (url); the
    most votes win, the earlier candidate of equals.  Without votes the base is NULL.  Nothing is fetched.
    Votes are added up before they are shuffled, so a key with very many files is a few rows a task.
    """
    f = files.withColumn("segmen", first_segment("path"))
    tried = f.select(key, "segmen", "path", F.posexplode(base_candidates("api_url", "page_url")).alias("urutan", "base"))
    tried = tried.withColumn("url", F.concat("base", "path"))
    hits = tried.join(known.select("url").distinct(), "url", "left_semi")
    votes = hits.groupBy(key, "segmen", "urutan", "base").agg(F.count("*").alias("suara"))
    best = votes.groupBy(key, "segmen").agg(F.max_by(F.struct("base", "suara"), F.struct("suara", -F.col("urutan"))).alias("b"))
    return f.join(best, [key, "segmen"], "left").select(*files.columns, "segmen", F.col("b.base").alias("base"), F.col("b.suara").alias("suara"))


def harvest_files(absolute: DataFrame, relative: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, url, judul): files of each answer with their titles, the first title of an address.

    ``absolute`` has (key, no, url, judul), ``relative`` (key, no, path, judul, api_url, page_url); absolute
    ones come first, paths without a base are left out.
    """
    r = resolve_bases(relative, known, key).filter("base is not null")
    rows = absolute.select(key, F.struct(F.lit(0).alias("r"), "no").alias("o"), "url", "judul").unionByName(
        r.select(key, F.struct(F.lit(1).alias("r"), "no").alias("o"), F.concat("base", "path").alias("url"), "judul"))
    return rows.groupBy(key, "url").agg(F.min_by("judul", "o").alias("judul"))


def with_registered_title(documents: DataFrame, registry: DataFrame, key: str, url: str, title: str) -> DataFrame:
    """Titles of ``registry`` (key, url, judul) replace those of documents where they say something."""
    t = registry.select(key, F.col("url").alias(url), F.col("judul").alias("__t"))
    better = F.coalesce(F.nullif(F.col("__t"), F.lit("")), F.col(title))
    return documents.join(t, [key, url], "left").withColumn(title, better).drop("__t")


def folder_members(roots: DataFrame, listing: DataFrame, root: str = "folder") -> DataFrame:
    """(root, id, nama, jalur): every file below each root folder, with the names of the folders on its way.

    ``listing`` has (folder, id, nama, jenis), ``jenis`` is ``berkas`` or ``folder``.  Folders may hold one another;
    a way stops where it would enter a folder it came through, so shared folders are listed on each way and rings
    end.  One round a level, each checkpointed; an unreadable folder has no rows in ``listing`` and adds none.
    """
    inside = listing.select(F.col("folder").alias("__in"), F.col("id").alias("__id"), F.col("nama").alias("__nama"), F.col("jenis").alias("__jenis"))
    level = roots.select(F.col(root).alias("root")).distinct()
    level = level.select("root", F.col("root").alias("di"), F.array("root").alias("lewat"), F.array().cast("array<string>").alias("jalur"))
    found = []
    while True:
        step = checkpoint(level.join(inside, F.col("di") == F.col("__in")))
        found.append(step.filter("__jenis = 'berkas'").select("root", F.col("__id").alias("id"), F.col("__nama").alias("nama"), "jalur"))
        level = step.filter((F.col("__jenis") == "folder") & ~F.array_contains("lewat", F.col("__id"))).select(
            "root", F.col("__id").alias("di"), F.concat("lewat", F.array("__id")).alias("lewat"), F.concat("jalur", F.array("__nama")).alias("jalur"))
        level = checkpoint(level)
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def api_frontier(files: DataFrame, links: DataFrame, robots: DataFrame, visited: DataFrame) -> DataFrame:
    """(url, depth, is_document, judul, no): what a site's services and pages add to its frontier, in order.

    ``files`` (url, judul, no) were named by the owner's service: only the robots rules of the file's own host
    hold, hosts without rules allow all; they enter at depth 1.  ``links`` (url, depth, is_document, no) are
    page links that passed admission already.  Both leave out ``visited`` (url).  An address named by both enters
    once, as a document with its title, at the smaller depth.  ``no`` orders: documents first, then arrival.
    """
    named = files.groupBy("url").agg(F.min_by("judul", "no").alias("judul"), F.min("no").alias("no"))
    checked = check_robots(named.withColumn("link", F.col("url")).withColumn("host", U.hostname("url")), robots, "host")
    ok = checked.filter("allowed").select("url", F.lit(1).alias("depth"), F.lit(True).alias("is_document"), "judul", "no")
    both = ok.unionByName(links.select("url", "depth", "is_document", F.lit(None).cast("string").alias("judul"), "no"))
    merged = both.groupBy("url").agg(
        F.min("depth").alias("depth"), F.bool_or("is_document").alias("is_document"), F.max("judul").alias("judul"),
        F.min(F.struct((~F.col("is_document")).alias("later"), "no")).alias("o"))
    merged = merged.join(visited.select("url").distinct(), "url", "left_anti")
    return merged.select("url", "depth", "is_document", "judul", F.col("o.no").alias("no"))
