"""Readers for the files of a crawl: records, manifests, logs, catalogs, raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import urls as U
from docloom.functions.text import slug, trim
from docloom.operators import vectors as V

MANIFEST = (
    "run_id string, site_id string, site_name string, dibuat string, file_vektor string, "
    "dokumen int, vektor int, dimensi int, chunk int, "
    "qdrant_push struct<status:string,point_terkirim:int,point_gagal:int>"
)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files, numbered without reading a file in one task.

    Lines are numbered inside their input split; the line counts of earlier splits of the same
    file, a table of one row per split, give the offset.
    """
    d = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__b"),
        F.monotonically_increasing_id().alias("__i"),
    )
    counts = d.groupBy("file", "__b").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    w = W.partitionBy("file").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    j = d.join(counts.drop("__n"), ["file", "__b"])
    return j.select(
        "file", (F.col("__i") - F.col("__first") + 1 + F.col("__before")).alias("line_no"), "value"
    )


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of vector-record files; broken lines stay as rows with ``masalah``."""
    return V.parse_records(numbered_lines(spark, path), "value", "line_no")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per manifest, newest first; the site defaults to the folder name."""
    d = spark.read.schema(MANIFEST).json(path, multiLine=True).withColumn(
        "file", F.col("_metadata.file_path")
    )
    folder = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    zero = F.lit(0)
    return d.select(
        F.substring("dibuat", 1, 10).alias("tanggal"),
        F.coalesce("site_id", folder).alias("site_id"),
        F.coalesce("site_name", "site_id", folder).alias("site_name"),
        F.coalesce("run_id", F.lit("")).alias("run_id"),
        "dibuat",
        "file_vektor",
        F.coalesce("dokumen", zero).alias("dokumen"),
        "chunk",
        F.coalesce("vektor", zero).alias("vektor"),
        F.coalesce("qdrant_push.point_terkirim", zero).alias("push_terkirim"),
        F.coalesce("qdrant_push.point_gagal", zero).alias("push_gagal"),
        F.coalesce("qdrant_push.status", F.lit("-")).alias("push"),
        "file",
    ).orderBy(F.desc("dibuat"))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines and bytes per file."""
    d = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("_metadata.file_size").alias("bytes"),
    )
    return d.groupBy("file").agg(
        F.count("*").alias("baris"), F.max("mtime").alias("mtime"), F.max("bytes").alias("bytes")
    )


def newest_file(files: DataFrame) -> DataFrame:
    """The most recently changed file, as one row."""
    return files.agg(F.max_by("file", F.struct("mtime", "file")).alias("file"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, pos, file) of run or daily logs."""
    return numbered_lines(spark, path).withColumnRenamed("line_no", "pos")


def run_log_texts(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, text): one whole run log per row, for the summary block only."""
    d = spark.read.text(path, wholetext=True)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.txt$", 1)
    return d.select(run.alias("run_id"), F.col("value").alias("text"))


def robots_texts(spark: SparkSession, path: str) -> DataFrame:
    """(host, robots): files named after their host."""
    d = spark.read.text(path, wholetext=True)
    host = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.txt$", 1)
    return d.select(host.alias("host"), F.col("value").alias("robots"))


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """(nama, path, bytes, mtime) of non-empty document files, without their contents."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    return d.filter(ext.isin(K.DOCUMENT_EXTENSIONS) & (F.col("length") > 0)).select(
        name.alias("nama"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime")
    )


def jobs(spark: SparkSession, path: str, schema: str, limit: int = 50) -> DataFrame:
    """Newest job files."""
    d = spark.read.schema(schema).json(path, multiLine=True)
    return d.select("*", F.col("_metadata.file_modification_time").alias("__m")).orderBy(F.desc("__m")).limit(limit).drop("__m")


def site_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per site of a catalog file: flat list, or an object with one of four list keys.

    ``defaults`` fill what an entry leaves out.  Missing ids come from the name or the host; a
    repeated host id gets its last path segment, then a number.
    """
    raw = spark.read.text(path, wholetext=True).select(
        F.try_parse_json(F.regexp_replace("value", "^﻿", "")).alias("v")
    )
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    wrapped = F.coalesce(
        *[F.try_variant_get("v", f"$.{k}", "array<variant>") for k in ["sites", "documents", "targets", "pages"]]
    )
    entries = F.when(is_list, F.try_variant_get("v", "$", "array<variant>")).otherwise(wrapped)
    d = raw.select(F.try_variant_get("v", "$.defaults", "variant").alias("__d"), F.posexplode(entries).alias("pos", "e"))

    def pick(kind, *names):
        from_entry = [F.try_variant_get("e", f"$.{n}", kind) for n in names]
        from_defaults = [F.try_variant_get("__d", f"$.{n}", kind) for n in names]
        return F.coalesce(*from_entry, *from_defaults)

    urls = F.coalesce(
        *[
            x
            for n in ["start_urls", "startUrls", "urls", "url"]
            for x in (
                F.try_variant_get("e", f"$.{n}", "array<string>"),
                F.when(F.schema_of_variant(F.try_variant_get("e", f"$.{n}", "variant")) == "STRING",
                       F.array(F.try_variant_get("e", f"$.{n}", "string"))),
            )
        ]
    )
    urls = F.filter(F.transform(urls, trim), lambda u: u != "")
    d = d.select(
        "pos",
        urls.alias("start_urls"),
        F.coalesce(pick("boolean", "enabled"), F.lit(True)).alias("enabled"),
        F.try_variant_get("e", "$.id", "string").alias("__id"),
        F.try_variant_get("e", "$.name", "string").alias("name"),
        pick("string", "document_type", "documentType").alias("document_type"),
        pick("string", "province").alias("province"),
        pick("string", "city").alias("city"),
        pick("string", "year").alias("year"),
        F.coalesce(pick("int", "chunk_size", "chunkSize"), F.lit(K.CHUNK_SIZE)).alias("chunk_size"),
        F.coalesce(pick("int", "chunk_overlap", "chunkOverlap"), F.lit(K.CHUNK_OVERLAP)).alias("chunk_overlap"),
        F.coalesce(pick("int", "min_chunk_length", "minChunkLength"), F.lit(K.MIN_CHUNK_LENGTH)).alias("min_chunk_length"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(pick("double", "max_link_ratio"), F.lit(K.MAX_LINK_RATIO)))).alias("max_link_ratio"),
        F.coalesce(F.try_variant_get("__d", "$.duplicate_similarity", "double"), F.lit(K.DUPLICATE_SIMILARITY)).alias("duplicate_similarity"),
        follow_mode(pick("string", "follow_external", "followExternal")).alias("follow_external"),
    ).filter(F.size("start_urls") > 0)
    first = F.get("start_urls", F.lit(0))
    by_name = F.when(trim("name") != "", slug("name"))
    given = F.coalesce(F.when(trim("__id") != "", slug("__id")), by_name)
    d = d.withColumn("__given", given).withColumn("__host", U.site_id(first)).withColumn(
        "__long", U.site_id(first, with_path=True)
    )
    # a catalog is one configuration file, so numbering its repeats by window is bounded
    w = W.partitionBy("__given", "__host").orderBy("pos")
    wl = W.partitionBy("__given", "__long").orderBy("pos")
    n, m = F.row_number().over(w), F.row_number().over(wl)
    auto = F.when(n == 1, F.col("__host")).when((m == 1) & (F.col("__long") != F.col("__host")), F.col("__long")).otherwise(
        F.concat("__host", F.lit("-"), n.cast("string"))
    )
    label_type = F.when(F.upper("document_type") != "WEB", F.upper("document_type"))
    label = F.when(
        F.coalesce(trim("document_type"), trim("city"), F.lit("")) != "",
        F.concat_ws(" ", label_type, F.nullif(trim("city"), F.lit("")), F.nullif(trim("year"), F.lit(""))),
    )
    return d.select(
        F.coalesce("__given", auto).alias("id"),
        F.coalesce(F.nullif(trim("name"), F.lit("")), F.nullif(label, F.lit("")), F.regexp_replace(U.host(first), r"^www\.", "")).alias("name"),
        *[c for c in d.columns if not c.startswith("__") and c not in ("name", "pos")],
        "pos",
    )


def follow_mode(value):
    v = F.lower(trim(value))
    return F.when(v.isin("off", "family", "all"), v).otherwise(F.lit("off"))


def as_local_fetch(files: DataFrame, url: str, path: str) -> DataFrame:
    """Fetch rows for documents already on disk."""
    return files.select(
        F.col(url).alias("url"), F.col(url).alias("effective_url"), F.lit(200).alias("http_status"),
        F.lit(True).alias("ok"), F.lit(False).alias("is_html"), F.col("bytes"), F.col(path).alias("path"),
    )
