"""Overlapping character windows, chunk filters and the 21-field payload.

All of it happens inside the document's row; the only row change is the final explode of
accepted chunks, so chunking a corpus needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids
from docloom.functions import markdown as M
from docloom.functions.text import TRIM_CHARS, blank_to_null, col, let, normalize_whitespace
from docloom.functions.urls import hostname


#: Rows whose windows are cut and handed on at a time.
WINDOW_ROWS = 128


@dataclass(frozen=True)
class ChunkOptions:
    size: int = K.CHUNK_SIZE
    overlap: int = K.CHUNK_OVERLAP
    min_length: int = K.MIN_CHUNK_LENGTH
    max_link_ratio: float = K.MAX_LINK_RATIO


PAYLOAD = [
    "document_id", "chunk_id", "chunk_no", "checksum", "title", "url", "page", "heading",
    "section", "content", "document_type", "province", "city", "year", "source", "sha256",
    "object_key", "file_url", "status", "created_at", "updated_at",
]


def _cut_points(text: str, size: int, overlap: int):
    """(start, cut) of each window; cuts snap to the last sentence or paragraph break."""
    n = len(text)
    if n <= size:
        yield 0, n
        return
    start = 0
    while start < n:
        end = min(start + size, n)
        cut = end
        if end < n:
            back = max(text.rfind("\n\n", start, end), text.rfind(". ", start, end)) - start
            if back > size * 0.5:
                cut = start + back + 1
        yield start, cut
        if cut >= n:
            return
        start = max(cut - overlap, start + 1)


def windows(text, size: int, overlap: int) -> Column:
    """array<struct(start, cut, text)> of the non-blank windows of each text."""

    parts = pa.struct([("start", pa.int32()), ("cut", pa.int32()), ("text", pa.string())])

    def some(texts: pa.Array) -> pa.Array:
        ends, starts, stops, pieces = [0], [], [], []
        for v in texts:
            t = v.as_py() or ""
            for start, stop in _cut_points(t, size, overlap):
                piece = t[start:stop].strip(TRIM_CHARS)
                if piece:
                    starts.append(start)
                    stops.append(stop)
                    pieces.append(piece)
            ends.append(len(pieces))
        rows = pa.StructArray.from_arrays(
            [pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(pieces, pa.string())], fields=list(parts))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    # a worker holds the windows of a few rows, not of a whole batch
    @F.arrow_udf("array<struct<start:int,cut:int,text:string>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            for at in range(0, len(b), WINDOW_ROWS):
                yield some(b.slice(at, WINDOW_ROWS))

    return cut(col(text))


def reject_reason(piece: Column, content: Column, o: ChunkOptions) -> Column:
    """Why a window is not stored: ``pendek``, ``tanpa_isi``, ``tautan``, or NULL."""

    def of_plain(plain):
        return (
            F.when(F.length(plain) < o.min_length, F.lit("tanpa_isi"))
            .when(M.link_ratio(piece, plain) > o.max_link_ratio, F.lit("tautan"))
            .when(F.length(content) < o.min_length, F.lit("tanpa_isi"))
        )

    return F.when(F.length(piece) < o.min_length, F.lit("pendek")).otherwise(let(M.plain_text(piece), of_plain))


def with_windows(df: DataFrame, markdown: str, o: ChunkOptions) -> DataFrame:
    """Add ``potongan``: windows with content, reject reason, heading and page; and
    ``judul_pertama``: the first heading.

    One expression with bound parts: a column used inside a lambda would be worked out again
    for every window once the optimizer moves the expression into a filter.
    """
    df = df.withColumn("__win", windows(markdown, o.size, o.overlap))
    df = df.withColumn("__found", M.headings(markdown))
    # columns of their own: of a struct, the whole would be worked out again for each field that is read
    df = df.withColumn("__texts", M.heading_texts("__found")).withColumn("__pages", M.page_marks("__found"))
    starts = F.transform("__win", lambda w: w["start"])
    lengths = F.transform("__win", lambda w: F.length(w["text"]))
    df = df.withColumn("__h", M.headings_at(F.col("__texts"), starts, lengths))
    df = df.withColumn("__p", M.pages_at(F.col("__pages"), starts))

    def piece(w, heading, page):
        return let(
            M.clean_chunk_text(w["text"]),
            lambda content: F.struct(
                w["start"].alias("start"),
                w["text"].alias("text"),
                content.alias("content"),
                reject_reason(w["text"], content, o).alias("alasan"),
                heading.alias("heading"),
                page.alias("page"),
            ),
        )

    built = let(
        F.struct(F.col("__h").alias("h"), F.col("__p").alias("p")),
        lambda m: F.transform("__win", lambda w, i: piece(w, F.get(m["h"], i), F.get(m["p"], i))),
    )
    df = df.withColumn("judul_pertama", F.get("__texts", F.lit(0))["text"])
    return df.withColumn("potongan", built).drop("__win", "__found", "__texts", "__pages", "__h", "__p")


def section_label(document_type, year) -> Column:
    """``TYPE YEAR``; NULL for web pages and blank types."""
    kind = F.upper(F.coalesce(col(document_type).cast("string"), F.lit("WEB")))
    parts = F.concat_ws(" ", kind, blank_to_null(col(year).cast("string")))
    return F.when(~kind.isin("", "WEB"), parts)


def payload_document_type(document_type) -> Column:
    return F.upper(blank_to_null(col(document_type).cast("string")))


def build_chunks(
    docs: DataFrame,
    stamp: str,
    options: ChunkOptions = ChunkOptions(),
    url: str = "url",
    title: str = "title",
    markdown: str = "markdown",
) -> DataFrame:
    """Payload rows (21 fields, fixed order) of every accepted window.

    ``docs`` may carry document_type, province, city, year, object_key, file_url.  ``stamp``
    is the run's time; it is passed in so that results can be repeated.
    """
    for name in ["document_type", "province", "city", "year", "object_key", "file_url"]:
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("string"))
    d = docs.withColumn("__md", normalize_whitespace(markdown)).filter(F.col("__md") != "")
    d = with_windows(d, "__md", options)
    d = d.select(
        ids.document_id(url).alias("document_id"),
        F.col(title).alias("title"),
        F.col(url).alias("url"),
        F.coalesce(section_label("document_type", "year"), F.col("judul_pertama")).alias("section"),
        payload_document_type("document_type").alias("document_type"),
        *[blank_to_null(F.col(c).cast("string")).alias(c) for c in ["province", "city", "year"]],
        hostname(url).alias("source"),
        ids.content_sha256("__md").alias("sha256"),
        F.col("object_key"),
        blank_to_null("file_url").alias("file_url"),
        F.lit("READY").alias("status"),
        F.lit(stamp).alias("created_at"),
        F.lit(stamp).alias("updated_at"),
        F.filter("potongan", lambda w: w["alasan"].isNull()).alias("__ok"),
    )
    # the outer form keeps the optimizer from evaluating the windows a second time as a filter
    c = d.select("*", F.posexplode_outer("__ok").alias("chunk_no", "__w")).drop("__ok")
    c = c.filter(F.col("chunk_no").isNotNull())
    c = c.select(
        "*",
        ids.chunk_id("document_id", "chunk_no").alias("chunk_id"),
        ids.content_sha256(F.col("__w.content")).alias("checksum"),
        F.col("__w.content").alias("content"),
        F.col("__w.heading").alias("heading"),
        F.col("__w.page").alias("page"),
    )
    return c.select(*PAYLOAD)
