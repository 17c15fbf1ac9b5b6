"""The whole flow: pages to markdown, cleaned, titled, deduplicated, chunked, embedded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids
from docloom.functions.html import html_title
from docloom.functions.markdown import first_heading
from docloom.functions.titles import with_title
from docloom.functions.urls import hostname
from docloom.operators.chunk import ChunkOptions, build_chunks
from docloom.operators.clean import cleaned_or_fallback
from docloom.operators.dedupe import all_duplicates, greedy_duplicates
from docloom.operators.htmlmd import html_to_markdown
from docloom.sources.services import add_vectors, hash_vectors
from docloom.session import stored, table


@dataclass(frozen=True)
class IngestOptions:
    chunk: ChunkOptions = field(default_factory=ChunkOptions)
    clean: bool = True
    drop_duplicates: bool = True
    similarity: float = K.DUPLICATE_SIMILARITY
    history: int | None = None  # documents remembered; None compares with all, over whole texts
    stamp: str = "1970-01-01T00:00:00.000Z"


def prepared_documents(pages: DataFrame, o: IngestOptions = IngestOptions()) -> DataFrame:
    """(page_id, site, url, title, markdown) of pages that are not duplicates.

    ``pages`` has page_id (arrival order), url and html.  The rendered markdown is written
    once, as Parquet: duplicate detection, titles and chunking read the columns they need.
    """
    head = {"url": F.col("url"), "site": hostname("url"), "page_title": html_title("html")}
    d = html_to_markdown(pages.select("page_id", "url", "html"), keep=head).drop("title")
    if o.clean:
        d = cleaned_or_fallback(d, "markdown", "markdown", o.chunk.min_length)
    d = d.withColumn("heading", first_heading("markdown"))
    d = stored(d.select("page_id", "site", "url", "page_title", "heading", "markdown"), "documents")
    d = with_title(d, "site", "page_id", "url", "", "", out="title", page_title="page_title", heading="heading")
    d = d.drop("page_title", "heading")
    if not o.drop_duplicates:
        return d
    names = ("site", "page_id", "url", "markdown")
    marks = all_duplicates(d, *names, o.similarity) if o.history is None else greedy_duplicates(d, *names, o.similarity, o.history)
    kept = marks.filter("accepted")
    return d.join(kept.select("page_id"), "page_id", "left_semi")


def ingest(
    pages: DataFrame,
    o: IngestOptions = IngestOptions(),
    model: Callable[[list[str]], list[list[float]]] = hash_vectors,
) -> DataFrame:
    """Vector records: the 21 payload fields and ``embedding``."""
    chunks = build_chunks(prepared_documents(pages, o), o.stamp, o.chunk)
    return add_vectors(chunks, "content", model)


def points(records: DataFrame) -> DataFrame:
    """(id, vector, payload) from vector records."""
    payload = [c for c in records.columns if c != "embedding"]
    return records.select(
        ids.point_id("chunk_id", "document_id", "chunk_no", "chunk_no").alias("id"),
        F.col("embedding").alias("vector"),
        F.struct(*payload).alias("payload"),
    )


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, chunks and characters per host."""
    o = IngestOptions(chunk=ChunkOptions(size=1000, overlap=100))
    chunks = build_chunks(prepared_documents(table(spark, sf_dir, "pages"), o), o.stamp, o.chunk)
    # one row per document first, so the count of documents needs no distinct
    per_doc = chunks.groupBy("source", "document_id").agg(
        F.count("*").alias("chunk"), F.sum(F.length("content")).alias("karakter")
    )
    return per_doc.groupBy("source").agg(
        F.count("*").alias("dokumen"), F.sum("chunk").alias("chunk"), F.sum("karakter").alias("karakter")
    ).orderBy("source")
