"""Whole-flow and streaming queries."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from docloom.operators import chunk as C, dedupe as D
from docloom.plans import ingest as I, sqltext as S
from docloom.plans.chunk_queries import _CLEAN, OVERLAP, SIZE, windows_sql
from docloom.plans.dedupe_queries import GREEDY_SQL, NO_LIMIT, greedy_sql
from docloom.plans.derived import LOG_SQL, documents, log_lines
from docloom.plans.registry import query
from docloom.session import table
from docloom.sources.services import add_vectors
from docloom.streaming import live, near


@query("ingest_summary")
def ingest_summary(spark, sf):
    """Pages to chunks per host.  Its stages have SQL twins of their own."""
    return I.ingest_summary(spark, sf)


@query(
    "ingest_documents",
    f"""WITH RECURSIVE {GREEDY_SQL}, src AS MATERIALIZED (SELECT d.doc_id, {S.norm_ws('d.text')} AS md FROM documents d
        JOIN f ON f.doc_id = d.doc_id AND f.accepted),
    {windows_sql('src', SIZE, OVERLAP)}, {_CLEAN}
    SELECT source, count(DISTINCT doc_id) AS dokumen, count(*) AS chunk, sum(length(c))::BIGINT AS karakter
    FROM chunks JOIN documents USING (doc_id) WHERE alasan IS NULL GROUP BY 1""",
)
def ingest_documents(spark, sf):
    """Documents per site: duplicates dropped, the rest cut into chunks and counted."""
    d = documents(spark, sf)
    kept = D.greedy_duplicates(d, "source", "doc_id", "url", "text").filter("accepted").select("doc_id")
    rest = d.join(kept, "doc_id", "left_semi").withColumn("title", F.col("url"))
    c = C.build_chunks(rest, "1970-01-01T00:00:00.000Z", C.ChunkOptions(SIZE, OVERLAP), markdown="text")
    per_doc = c.groupBy("source", "document_id").agg(
        F.count("*").alias("chunk"), F.sum(F.length("content")).alias("karakter")
    )
    return per_doc.groupBy(F.regexp_extract("source", r"^([^.]+)", 1).alias("source")).agg(
        F.count("*").alias("dokumen"), F.sum("chunk").alias("chunk"), F.sum("karakter").alias("karakter")
    )


@query(
    "vector_records",
    f"""WITH RECURSIVE src AS MATERIALIZED (SELECT doc_id, {S.norm_ws('text')} AS md FROM documents), {windows_sql('src', SIZE, OVERLAP)}, {_CLEAN}
    SELECT {S.uuid5(S.DOC_URL)} AS document_id, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS chunk_no, sha256(c) AS checksum, 64 AS dimensi
    FROM chunks JOIN documents USING (doc_id) WHERE alasan IS NULL""",
)
def vector_records(spark, sf):
    """Chunks of all documents with their vectors; the vectors come from a digest, SQL knows their length."""
    d = documents(spark, sf).withColumn("title", F.col("url"))
    c = C.build_chunks(d, "1970-01-01T00:00:00.000Z", C.ChunkOptions(SIZE, OVERLAP), markdown="text")
    e = add_vectors(c, "content")
    return e.select("document_id", "chunk_no", "checksum", F.size("embedding").alias("dimensi"))


def _event_stream(spark, sf):
    path = os.path.join(sf, "events.parquet*")
    return spark.readStream.schema(table(spark, sf, "events").schema).parquet(path)


@query(
    "stream_live_counts",
    f"""WITH {LOG_SQL} SELECT run_id, count(*) AS baris, count(*) FILTER (stage = 'DOC_AFTER' AND status = 'SUKSES') AS dokumen,
      coalesce(sum(vektor) FILTER (stage = 'DOC_AFTER' AND status = 'SUKSES'), 0)::BIGINT AS vektor, bool_or(stage = 'RUN_END') AS selesai
    FROM log GROUP BY 1""",
)
def stream_live_counts(spark, sf):
    lines = log_lines(spark, sf, _event_stream(spark, sf))
    return live.run_to_end(live.live_counts(lines), "complete", "live")


@query(
    "stream_first_texts",
    "SELECT source, sha1(text) AS fingerprint, count(DISTINCT sha1(text)) AS jumlah FROM documents GROUP BY 1, 2",
)
def stream_first_texts(spark, sf):
    path = os.path.join(sf, "documents.parquet*")
    docs = spark.readStream.schema(table(spark, sf, "documents").schema).parquet(path)
    s = live.first_seen_texts(docs.select("source", "text"), "source", "text").drop("text")
    rows = live.run_to_end(s, "append", "texts")
    return rows.groupBy("source", "fingerprint").agg(F.count("*").alias("jumlah"))


@query(
    "stream_near_duplicates",
    f"""WITH RECURSIVE {greedy_sql(NO_LIMIT, NO_LIMIT)}
    SELECT f.doc_id, f.accepted, f.jenis, p.doc_id AS pertama, f.skor FROM f LEFT JOIN s p ON p.source = f.source AND p.i = f.pertama
    WHERE f.doc_id IS NOT NULL""",
)
def stream_near_duplicates(spark, sf):
    """The stream twin of ``near_dup_greedy_unlimited``: state per site instead of a graph."""
    path = os.path.join(sf, "documents.parquet*")
    docs = documents(spark, sf, spark.readStream.schema(table(spark, sf, "documents").schema).parquet(path))
    rows = live.run_to_end(near.near_duplicates(docs, "source", "doc_id", "url", "text"), "append", "near", once=True, settings=near.SETTINGS)
    first = F.regexp_extract("url_pertama", "([0-9]+)$", 1).try_cast("long")
    return rows.select(F.col("seq").alias("doc_id"), "accepted", "jenis", first.alias("pertama"), "skor")
