"""Queries over windows, chunk filters, as-of lookups, embedding batches and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import markdown as M, text as T
from docloom.operators import chunk as C, vectors as V
from docloom.plans import sqltext as S
from docloom.plans.derived import SECTIONED_SQL, sectioned
from docloom.plans.registry import query
from docloom.session import table

SIZE, OVERLAP = 1000, 100


def windows_sql(src: str, size: int = SIZE, overlap: int = OVERLAP) -> str:
    """CTE ``win(doc_id, md, n, start, cut)`` over ``src(doc_id, md)``."""

    def cut(s):
        look = f"substr(md, {s} + 1, {size})"

        def last(mark, rev):
            return (
                f"CASE WHEN strpos(reverse({look}), {rev}) = 0 THEN -1 "
                f"ELSE length({look}) - strpos(reverse({look}), {rev}) - 1 END"
            )

        br = f"greatest({last('. ', chr(39) + ' .' + chr(39))}, {last('', 'chr(10) || chr(10)')})"
        return (
            f"CASE WHEN {s} + {size} >= n THEN n WHEN {br} > {size} * 0.5 THEN {s} + {br} + 1 "
            f"ELSE {s} + {size} END"
        )

    return f"""
    win AS (
      SELECT doc_id, md, n, 0::BIGINT AS start, ({cut('0')})::BIGINT AS cut
      FROM (SELECT doc_id, md, length(md) AS n FROM {src})
      UNION ALL
      SELECT doc_id, md, n, s, ({cut('s')})::BIGINT FROM (
        SELECT doc_id, md, n, greatest(cut - {overlap}, start + 1) AS s FROM win WHERE cut < n)),
    piece AS MATERIALIZED (SELECT doc_id, start, cut, {S.trim('substr(md, start + 1, cut - start)')} AS p
      FROM win WHERE {S.trim('substr(md, start + 1, cut - start)')} <> '')"""


_RAW = "src AS (SELECT doc_id, text AS md FROM documents)"
_NORM = f"src AS MATERIALIZED (SELECT doc_id, {S.norm_ws('text')} AS md FROM documents)"
_SECT = f"src AS MATERIALIZED (SELECT doc_id, {S.norm_ws('md0')} AS md FROM (SELECT doc_id, {SECTIONED_SQL} AS md0 FROM documents))"


@query(
    "chunk_windows",
    f"WITH RECURSIVE {_RAW}, {windows_sql('src')} SELECT doc_id, start, cut, sha1(p) AS isi FROM piece",
)
def chunk_windows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", C.windows("text", SIZE, OVERLAP).alias("w"))
    d = d.select("doc_id", F.explode("w").alias("w"))
    return d.select("doc_id", "w.start", "w.cut", F.sha1("w.text").alias("isi"))


# the clean text of a window; marks inside words stay, which needs the neighbours of a run
_CLEAN = rf"""
c1 AS MATERIALIZED (SELECT doc_id, start, p, {S.rep(S.rep(S.rep('p', r'\[([^\]\n]*)\]\([^)\n]*\)', chr(92) + '1'), r'\[([^\]\n]*)\]', chr(92) + '1'), r'(?m)^[ \t]{0,3}#{1,6}[ \t]*', '')} AS t FROM piece),
c2 AS MATERIALIZED (SELECT doc_id, start, p, regexp_split_to_array(t, '#+') AS parts, regexp_extract_all(t, '#+') AS runs FROM c1),
c3 AS MATERIALIZED (SELECT doc_id, start, p, array_to_string(list_transform(parts, lambda x, i: x || CASE WHEN i <= len(runs)
    THEN repeat('#', least(length(runs[i]), regexp_matches(x, '[\p{{L}}\p{{N}}]$')::INT + regexp_matches(parts[i + 1], '^[\p{{L}}\p{{N}}]')::INT)) ELSE '' END), '') AS t FROM c2),
c4 AS MATERIALIZED (SELECT doc_id, start, p, {S.rep(S.rep(S.rep(S.rep('t', r'\*\*([^*\n]+)\*\*', chr(92) + '1'), r'__([^_\n]+)__', chr(92) + '1'), '~~([^~' + chr(92) + 'n]+)~~', chr(92) + '1'), '`([^`' + chr(92) + 'n]+)`', chr(92) + '1')} AS t FROM c3),
c5 AS MATERIALIZED (SELECT doc_id, start, p, {S.norm_ws(S.rep('t', r'(?m)^[ \t]{0,3}>[ \t]?', ''))} AS c FROM c4),
c6 AS MATERIALIZED (SELECT *, {S.collapse(S.rep(S.rep('p', r'\[([^\]\n]*)\]\([^)\n]*\)', chr(92) + '1'), r'[#*_`>|~]+', ' '))} AS plain FROM c5),
c7 AS MATERIALIZED (SELECT *, length({S.rep('p', S.WS + '+', '')}) AS padat, length({S.rep('plain', S.WS + '+', '')}) AS nyata FROM c6),
chunks AS MATERIALIZED (SELECT *, CASE WHEN length(p) < {K.MIN_CHUNK_LENGTH} THEN 'pendek' WHEN length(plain) < {K.MIN_CHUNK_LENGTH} THEN 'tanpa_isi'
  WHEN padat > 0 AND nyata < padat AND (padat - nyata)::DOUBLE / padat > {K.MAX_LINK_RATIO} THEN 'tautan'
  WHEN length(c) < {K.MIN_CHUNK_LENGTH} THEN 'tanpa_isi' END AS alasan FROM c7)
"""


@query(
    "chunk_filter_reasons",
    f"""WITH RECURSIVE {_NORM}, {windows_sql('src')}, {_CLEAN}
    SELECT doc_id, count(*) AS jendela, count(*) FILTER (alasan IS NULL) AS diterima,
      count(*) FILTER (alasan = 'pendek') AS pendek, count(*) FILTER (alasan = 'tanpa_isi') AS tanpa_isi,
      count(*) FILTER (alasan = 'tautan') AS tautan FROM chunks GROUP BY 1""",
)
def chunk_filter_reasons(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.normalize_whitespace("text").alias("md"))
    # a trimmed text that is not empty has a window; a filter on the windows would work them out twice
    d = C.with_windows(d.filter(F.col("md") != ""), "md", C.ChunkOptions(SIZE, OVERLAP))
    w = F.col("potongan")

    def n(reason):
        return F.size(F.filter(w, lambda x: x["alasan"].eqNullSafe(F.lit(reason))))

    return d.select(
        "doc_id", F.size(w).alias("jendela"), n(None).alias("diterima"), n("pendek").alias("pendek"),
        n("tanpa_isi").alias("tanpa_isi"), n("tautan").alias("tautan"),
    )


@query(
    "chunk_text",
    f"""WITH RECURSIVE {_NORM}, {windows_sql('src')}, {_CLEAN}
    SELECT doc_id, start, sha1(c) AS isi, round(CASE WHEN padat = 0 OR nyata >= padat THEN 0 ELSE (padat - nyata)::DOUBLE / padat END, 6) AS rasio FROM chunks""",
)
def chunk_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.normalize_whitespace("text").alias("md"))
    d = d.select("doc_id", F.explode(C.windows("md", SIZE, OVERLAP)).alias("w"))
    return d.select(
        "doc_id", "w.start", F.sha1(M.clean_chunk_text("w.text")).alias("isi"),
        F.round(M.link_ratio("w.text"), 6).alias("rasio"),
    )


@query(
    "chunk_payload",
    f"""WITH RECURSIVE {_NORM}, {windows_sql('src')}, {_CLEAN},
    d AS (SELECT doc_id, lang, source, {S.uuid5(S.DOC_URL)} AS document_id, {S.DOC_URL} AS url FROM documents),
    k AS (SELECT doc_id, start, c, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS chunk_no FROM chunks WHERE alasan IS NULL)
    SELECT document_id, document_id || ':' || chunk_no AS chunk_id, chunk_no, sha256(c) AS checksum,
      'Dokumen ' || doc_id AS title, url, NULL::INT AS page, NULL AS heading,
      CASE WHEN lang = 'en' THEN NULL ELSE upper(lang) || ' 2024' END AS section, c AS content,
      upper(CASE WHEN lang = 'en' THEN NULL ELSE lang END) AS document_type, source AS province, NULL AS city, '2024' AS year,
      source || '.example.com' AS source, sha256(md) AS sha256, NULL AS object_key, NULL AS file_url, 'READY' AS status,
      '2024-01-01T00:00:00.000Z' AS created_at, '2024-01-01T00:00:00.000Z' AS updated_at
    FROM k JOIN d USING (doc_id) JOIN src USING (doc_id)""",
)
def chunk_payload(spark, sf):
    d = table(spark, sf, "documents").select(
        F.concat(F.lit("Dokumen "), F.col("doc_id").cast("string")).alias("title"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/dokumen/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("markdown"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("document_type"),
        F.concat(F.lit(" "), "source").alias("province"),
        F.lit("  ").alias("city"),
        F.lit("2024").alias("year"),
    )
    return C.build_chunks(d, "2024-01-01T00:00:00.000Z", C.ChunkOptions(SIZE, OVERLAP))


_MARKS = r"""
ln AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS x, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM src),
off AS (SELECT doc_id, x, coalesce(sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM ln),
hd AS MATERIALIZED (SELECT doc_id, o, """ + S.collapse(S.rep(S.ext("x", r"^[ \t]{0,3}#{1,6}[ \t]+(.+)$"), "[#*_`]+", "")) + r""" AS h,
  TRY_CAST(regexp_extract(x, '(?i)^[ \t]{0,3}#{1,6}[ \t]+Page[ \t]+([0-9]+)[ \t]*$', 1) AS INT) AS pg
  FROM off WHERE regexp_matches(x, '^[ \t]{0,3}#{1,6}[ \t]+.+$'))
"""


@query(
    "heading_asof",
    f"""WITH RECURSIVE {_SECT}, {windows_sql('src')}, {_MARKS}
    SELECT p.doc_id, p.start, coalesce(arg_max(h, o) FILTER (o <= p.start),
      arg_max(h, o) FILTER (o > p.start AND o < p.start + length(p.p))) AS heading
    FROM piece p LEFT JOIN (SELECT * FROM hd WHERE h <> '') hd ON hd.doc_id = p.doc_id GROUP BY 1, 2""",
)
def heading_asof(spark, sf):
    d = _sections(spark, sf).select("doc_id", F.explode_outer("potongan").alias("w"))
    return d.filter("w is not null").select("doc_id", "w.start", "w.heading")


def _sections(spark, sf):
    md = T.normalize_whitespace(sectioned("text"))
    d = table(spark, sf, "documents").select("doc_id", md.alias("md"))
    return C.with_windows(d, "md", C.ChunkOptions(SIZE, OVERLAP))


@query(
    "page_asof",
    f"""WITH RECURSIVE {_SECT}, {windows_sql('src')}, {_MARKS}
    SELECT p.doc_id, p.start, coalesce(arg_max(pg, o) FILTER (pg IS NOT NULL AND o <= p.start), arg_min(pg, o) FILTER (pg IS NOT NULL)) AS page
    FROM piece p LEFT JOIN hd ON hd.doc_id = p.doc_id GROUP BY 1, 2""",
)
def page_asof(spark, sf):
    d = _sections(spark, sf).select("doc_id", F.explode_outer("potongan").alias("w"))
    return d.filter("w is not null").select("doc_id", "w.start", "w.page")


@query(
    "heading_offsets",
    f"WITH RECURSIVE {_SECT}, {_MARKS} SELECT doc_id, o::INT AS mulai, h AS judul FROM hd WHERE h <> ''",
)
def heading_offsets(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.normalize_whitespace(sectioned("text")).alias("md"))
    d = d.select("doc_id", M.headings("md").alias("h"))
    d = d.select("doc_id", F.explode(M.heading_texts("h")).alias("h"))
    return d.select("doc_id", F.col("h.offset").alias("mulai"), F.col("h.text").alias("judul"))


# --- batches and vectors --------------------------------------------------------


@query(
    "vector_batches",
    f"""WITH RECURSIVE {_RAW}, {windows_sql('src')},
    r AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS i, length(p) AS s FROM piece),
    f AS (SELECT doc_id, i, s, 0 AS no, 1 AS n, s AS chars FROM r WHERE i = 1
      UNION ALL
      SELECT r.doc_id, r.i, r.s, f.no + (f.n >= 8 OR f.chars + r.s > 4000)::INT,
        CASE WHEN f.n >= 8 OR f.chars + r.s > 4000 THEN 1 ELSE f.n + 1 END,
        CASE WHEN f.n >= 8 OR f.chars + r.s > 4000 THEN r.s ELSE f.chars + r.s END
      FROM f JOIN r ON r.doc_id = f.doc_id AND r.i = f.i + 1)
    SELECT doc_id, no, count(*) AS jumlah, sum(s)::BIGINT AS karakter FROM f GROUP BY 1, 2""",
)
def vector_batches(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", C.windows("text", SIZE, OVERLAP).alias("w"))
    d = d.withColumn("s", F.transform("w", lambda x: F.length(x["text"])))
    d = d.select("doc_id", F.explode(F.arrays_zip("s", V.pack_batches("s", 8, 4000).alias("b"))).alias("z"))
    return d.groupBy("doc_id", F.col("z.b").alias("no")).agg(
        F.count("*").alias("jumlah"), F.sum("z.s").alias("karakter")
    )


@query(
    "zip_vectors",
    """WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id % 5 <> 0)
    SELECT doc_id, unnest(generate_series(1, len(l))) AS no, unnest(list_transform(l, lambda x: md5(x))) AS chunk,
      unnest(list_transform(l, lambda x: length(x)::DOUBLE)) AS nilai FROM d""",
)
def zip_vectors(spark, sf):
    """Answers for every fifth document are one short, so those batches are rejected."""
    lines = F.split("text", "\n")
    answers = F.transform(lines, lambda x: F.array(F.length(x).cast("double")))
    short = F.when(F.col("doc_id") % 5 == 0, F.slice(answers, 1, F.size(answers) - 1)).otherwise(answers)
    d = table(spark, sf, "documents").select("doc_id", V.zip_embeddings(lines, short).alias("z"))
    d = d.select("doc_id", F.posexplode("z").alias("no", "z"))
    return d.select(
        "doc_id", (F.col("no") + 1).alias("no"), F.md5("z.chunk").alias("chunk"),
        F.col("z.embedding")[0].alias("nilai"),
    )


def record_lines(spark, sf):
    """Vector-record lines; labels decide which are cut, lack a vector, or carry another id form."""
    e = table(spark, sf, "embeddings")
    vid = F.col("vec_id").cast("string")
    chunk = (
        F.when(F.col("label") == 5, F.lit("0D19CCFF-6467-58B5-8BE3-D478D0EB3D07"))
        .when(F.col("label") == 6, vid)
        .otherwise(F.concat(vid, F.lit(":7")))
    )
    vector = F.when(F.col("label") != 4, F.col("embedding"))
    no = F.when(F.col("label") != 7, F.lit(7))
    line = F.to_json(F.struct(chunk.alias("chunk_id"), vid.alias("document_id"), no.alias("chunk_no"), vector.alias("embedding")))
    line = F.when(F.col("label") == 3, F.substring(line, 1, 20)).otherwise(line)
    return e.select("vec_id", "label", (F.col("vec_id") + 1).alias("baris"), line.alias("value"))


@query(
    "points_valid",
    f"""SELECT vec_id, CASE WHEN label IN (3, 4) THEN NULL WHEN label = 5 THEN '0d19ccff-6467-58b5-8be3-d478d0eb3d07'
        WHEN label = 6 THEN vec_id::VARCHAR WHEN label = 7 THEN {S.uuid5("'chunk:' || vec_id || ':' || (vec_id + 1)")}
        ELSE {S.uuid5("'chunk:' || vec_id || ':7'")} END AS point_id,
      CASE WHEN label IN (3, 4) THEN NULL ELSE len(embedding) END AS dimensi,
      CASE WHEN label IN (3, 4) THEN NULL ELSE round(embedding[1]::DOUBLE, 4) END AS pertama,
      CASE label WHEN 3 THEN 'JSON tidak valid' WHEN 4 THEN 'field embedding kosong' END AS masalah FROM embeddings""",
)
def points_valid(spark, sf):
    p = V.parse_records(record_lines(spark, sf), "value", "baris")
    return p.select(
        "vec_id", "point_id", F.when(F.col("vector").isNotNull(), F.size("vector")).alias("dimensi"),
        F.round(F.get("vector", F.lit(0)), 4).alias("pertama"), "masalah",
    )


@query(
    "dimension_check",
    """SELECT label, count(*) AS points, min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim,
      min(len(embedding)) = max(len(embedding)) AS konsisten FROM embeddings GROUP BY 1""",
)
def dimension_check(spark, sf):
    return V.dimension_report(table(spark, sf, "embeddings"), ["label"], "embedding")


@query(
    "upload_batches",
    f"""WITH r AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // {K.UPSERT_BATCH} + 1 AS batch FROM embeddings)
    SELECT batch, count(*) AS point, min(vec_id) AS awal, max(vec_id) AS akhir FROM r GROUP BY 1""",
)
def upload_batches(spark, sf):
    b = V.upload_batches(table(spark, sf, "embeddings").select("vec_id"), [F.col("vec_id")])
    return b.groupBy("batch").agg(
        F.count("*").alias("point"), F.min("vec_id").alias("awal"), F.max("vec_id").alias("akhir")
    )


@query(
    "latest_points",
    """SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
      max(event_id) AS event_id FROM events GROUP BY 1""",
)
def latest_points(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return V.latest_points(e, "user_id", "event_id")


@query(
    "push_stats",
    """WITH a AS (SELECT l_suppkey, sum(l_quantity::BIGINT)::BIGINT AS point_terbaca,
        sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS point_terkirim,
        sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT AS point_gagal,
        count(*) AS batch, count(*) FILTER (l_returnflag = 'R') AS batch_gagal FROM lineitem GROUP BY 1)
    SELECT *, CASE WHEN point_terbaca = 0 THEN 'GAGAL' WHEN batch_gagal = 0 THEN 'SUKSES'
      WHEN point_terkirim > 0 THEN 'SUKSES_SEBAGIAN' ELSE 'GAGAL' END AS status FROM a""",
)
def push_stats(spark, sf):
    b = table(spark, sf, "lineitem").select(
        "l_suppkey", F.col("l_quantity").cast("long").alias("n"), (F.col("l_returnflag") != "R").alias("ok")
    )
    return V.push_report(b, ["l_suppkey"])
