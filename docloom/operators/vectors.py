"""Embedding batches, vector records, points and their validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids
from docloom.functions.arrays import packed
from docloom.functions.text import col
from docloom.operators.skew import running_row_number


def pack_batches(lengths, max_items: int = K.BATCH_MAX_CHUNKS, max_chars: int = K.BATCH_MAX_CHARS) -> Column:
    """array<int> of batch numbers for one document's chunk lengths, greedily packed.

    A new batch starts when the current one is full or would pass ``max_chars``; an oversized
    chunk travels alone.  Batches never cross documents, so the work stays in the row.
    """
    return packed(lengths, max_items, max_chars)


def zip_embeddings(chunks, embeddings) -> Column:
    """Pair chunk i with embedding i; NULL when the counts differ (the batch is rejected)."""
    c, e = col(chunks), col(embeddings)
    return F.when(
        F.size(c) == F.size(e),
        F.zip_with(c, e, lambda a, b: F.struct(a.alias("chunk"), b.alias("embedding"))),
    )


RECORD = "chunk_id string, document_id string, chunk_no string, embedding array<double>"


def parse_records(lines: DataFrame, value: str, line_no: str) -> DataFrame:
    """Add id, vector, payload and ``masalah`` (why a line is no point) to vector-record lines."""
    d = lines.withColumn("__v", F.try_parse_json(value))
    d = d.withColumn("__ok", F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False)))
    d = d.withColumn("__r", F.from_json(value, RECORD))
    vector = F.col("__r.embedding")
    blank = F.trim(F.col(value)) == ""
    problem = F.when(~F.col("__ok"), F.lit("JSON tidak valid")).when(
        F.coalesce(F.size(vector), F.lit(0)) <= 0, F.lit("field embedding kosong")
    )
    d = d.filter(~blank).withColumn("masalah", problem)
    point = ids.point_id("__r.chunk_id", "__r.document_id", "__r.chunk_no", line_no)
    usable = F.col("masalah").isNull()
    return d.select(
        *[c for c in lines.columns],
        F.when(usable, point).alias("point_id"),
        F.when(usable, vector).alias("vector"),
        "masalah",
    )


def dimension_report(points: DataFrame, by: list[str], vector: str = "vector") -> DataFrame:
    """Points, smallest and largest dimension, and whether they agree."""
    n = F.size(vector)
    return points.groupBy(*by).agg(
        F.count("*").alias("points"),
        F.min(n).alias("min_dim"),
        F.max(n).alias("max_dim"),
        (F.min(n) == F.max(n)).alias("konsisten"),
    )


def require_one_dimension(points: DataFrame, vector: str = "vector", expected: int = 0) -> int:
    """The single dimension of all points; raises on mixed, missing or unexpected ones."""
    r = dimension_report(points, [], vector).first()
    if not r or r["points"] == 0:
        raise ValueError("no point with a vector")
    if not r["konsisten"]:
        raise ValueError(f"mixed dimensions: {r['min_dim']} to {r['max_dim']}")
    if expected and r["min_dim"] != expected:
        raise ValueError(f"dimension {r['min_dim']}, expected {expected}")
    return r["min_dim"]


def upload_batches(points: DataFrame, order: list[Column], size: int = K.UPSERT_BATCH) -> DataFrame:
    """Add ``batch``: consecutive groups of ``size`` points over the whole file."""
    d = _global_rank(points, order)
    return d.withColumn("batch", F.floor((F.col("__rn") - 1) / size).cast("long") + 1)


def _global_rank(points: DataFrame, order: list[Column]) -> DataFrame:
    one = points.withColumn("__one", F.lit(1))
    return running_row_number(one, ["__one"], order, "__rn").drop("__one")


def latest_points(points: DataFrame, key: str, order: str) -> DataFrame:
    """Upsert result: the last written row of each point id (a map-side combinable aggregate)."""
    rest = [c for c in points.columns if c != key]
    return points.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(
        key, *[F.col(f"__r.{c}").alias(c) for c in rest]
    )


def push_report(batches: DataFrame, by: list[str]) -> DataFrame:
    """Points read, sent and failed, batches, and the status of the whole upload.

    ``batches`` has one row per batch: n (points) and ok.
    """
    a = batches.groupBy(*by).agg(
        F.sum("n").alias("point_terbaca"),
        F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).alias("point_terkirim"),
        F.sum(F.when(F.col("ok"), 0).otherwise(F.col("n"))).alias("point_gagal"),
        F.count("*").alias("batch"),
        F.count_if(~F.col("ok")).alias("batch_gagal"),
    )
    return a.withColumn(
        "status",
        F.when(F.col("point_terbaca") == 0, F.lit("GAGAL"))
        .when(F.col("batch_gagal") == 0, F.lit("SUKSES"))
        .when(F.col("point_terkirim") > 0, F.lit("SUKSES_SEBAGIAN"))
        .otherwise(F.lit("GAGAL")),
    )
