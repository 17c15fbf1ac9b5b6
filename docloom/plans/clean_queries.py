"""Queries over markdown cleaning: lines, blocks, labels, counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import markdown as M, text as T
from docloom.operators import clean as C
from docloom.plans import sqltext as S
from docloom.plans.derived import SERVICE_SQL, service_markdown
from docloom.plans.registry import query
from docloom.session import table


def _service(spark, sf):
    return table(spark, sf, "pages").select("page_id", service_markdown().alias("md"))


@query(
    "noise_lines",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents),
    p0 AS MATERIALIZED (SELECT doc_id, x, {S.plain_line('x')} AS p FROM l),
    p AS MATERIALIZED (SELECT *, {S.words('p')} AS kw FROM p0)
    SELECT doc_id, count(*) AS baris, count(*) FILTER ({S.trim('x')} <> '' AND {S.noise('p', 'kw')}) AS noise,
      count(*) FILTER ({S.trim('x')} = '') AS kosong FROM p GROUP BY 1""",
)
def noise_lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", C.flag_lines(F.col("text")).alias("l"))
    return d.select(
        "doc_id", F.size("l").alias("baris"), F.size(F.filter("l", lambda x: x["noise"])).alias("noise"),
        F.size(F.filter("l", lambda x: x["line"] == "")).alias("kosong"),
    )


@query(
    "tidy_labels",
    f"""WITH l AS (SELECT doc_id, substr(text, 1, 60) || ' ' || string_split(text, ' ')[1] || '...' AS x FROM documents)
    SELECT doc_id, {S.tidy_label('x')} AS label, {S.fix_target("replace(x, ' ', chr(92))")} AS tujuan FROM l""",
)
def tidy_labels(spark, sf):
    x = F.concat(
        F.substring("text", 1, 60), F.lit(" "), F.get(F.split("text", " "), F.lit(0)), F.lit("...")
    )
    d = table(spark, sf, "documents").select("doc_id", x.alias("x"))
    return d.select(
        "doc_id", M.tidy_label("x").alias("label"),
        M.fix_target(F.replace("x", F.lit(" "), F.lit("\\"))).alias("tujuan"),
    )


_TEXT_STEPS = rf"""
a AS (SELECT page_id, replace(replace(md, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM svc),
b AS (SELECT page_id, len(regexp_extract_all(t, '(?s)<!--.*?-->')) AS komentar, {S.rep('t', '(?s)<!--.*?-->', '')} AS t FROM a),
c AS (SELECT page_id, komentar, len(regexp_extract_all(t, '!\[[^\]]*\]\([^)\n]*\)')) AS gambar,
  {S.rep('t', r'!\[[^\]]*\]\([^)\n]*\)', '')} AS t FROM b),
d AS (SELECT page_id, komentar, gambar, {S.replace_each('t', r'\]\(([^)\n]*)\)', 1, lambda m: "'](' || " + S.fix_target(m) + " || ')'")} AS t FROM c),
e AS (SELECT page_id, komentar, gambar, len(regexp_extract_all(t, '\[[ \t]*\]\([^)\n]*\)')) AS label_kosong,
  {S.rep('t', r'\[[ \t]*\]\([^)\n]*\)', '')} AS t FROM d),
f AS (SELECT page_id, komentar, gambar, label_kosong, {S.replace_each('t', r'\[([^\]\n]+)\]', 1, lambda m: "'[' || " + S.tidy_label(m) + " || ']'")} AS t FROM e),
l AS (SELECT page_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM f),
p0 AS MATERIALIZED (SELECT *, {S.plain_line('x')} AS p FROM l),
p1 AS MATERIALIZED (SELECT *, {S.words('p')} AS kw FROM p0),
n AS MATERIALIZED (SELECT page_id, i, CASE WHEN {S.trim('x')} = '' THEN '' ELSE {S.rep('x', '[ \t\n\r]+$', '')} END AS x,
  {S.trim('x')} <> '' AND {S.noise('p', 'kw')} AS noise FROM p1),
k AS (SELECT page_id, i, x, sum(CASE WHEN x = '' THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS g
  FROM n WHERE NOT noise),
blk AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY g) AS no, b FROM (
  SELECT page_id, g, string_agg(x, chr(10) ORDER BY i) AS b FROM k WHERE x <> '' GROUP BY 1, 2)),
kind AS MATERIALIZED (SELECT page_id, no, b, {S.block_kind('b')} AS jenis, length(b) - length(replace(b, chr(10), '')) + 1 AS baris FROM blk),
isl AS (SELECT *, sum(CASE WHEN jenis = 'navigasi' THEN 0 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY no) AS g FROM kind),
wgt AS (SELECT *, CASE WHEN jenis = 'navigasi' THEN sum(CASE WHEN jenis = 'navigasi' THEN baris END) OVER (PARTITION BY page_id, g) END AS bobot FROM isl),
nav AS (SELECT *, (jenis = 'label' OR coalesce(bobot >= {K.NAV_RUN_MIN}, false)) AS buang FROM wgt)
"""


@query(
    "block_kinds",
    f"""WITH {SERVICE_SQL}, {_TEXT_STEPS} SELECT page_id, no, jenis, baris FROM nav""",
)
def block_kinds(spark, sf):
    d = _text_steps(_service(spark, sf))
    # not outer, a filter on the array is put below, and works all blocks out a second time
    d = d.select("page_id", F.posexplode_outer("__b").alias("i", "b")).filter(F.col("i").isNotNull())
    return d.select(
        "page_id", (F.col("i") + 1).alias("no"), M.block_kind("b").alias("jenis"),
        (F.regexp_count("b", F.lit("\n")) + 1).alias("baris"),
    )


def _text_steps(d):
    t = F.regexp_replace("md", r"\r\n?", "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", ""), M.IMAGE, "")
    d = d.withColumn("__t", M.fix_link_targets(t))
    d = d.withColumn("__t", M.tidy_link_labels(F.regexp_replace("__t", M.EMPTY_LINK, "")))
    d = d.withColumn("__l", C.flag_lines(F.col("__t")))
    kept = F.transform(F.filter("__l", lambda x: ~x["noise"]), lambda x: x["line"])
    return d.withColumn("__b", C.split_blocks(F.array_join(kept, "\n")))


@query(
    "nav_runs",
    f"""WITH {SERVICE_SQL}, {_TEXT_STEPS} SELECT page_id, count(*) FILTER (NOT buang) AS sisa,
      count(*) FILTER (buang) AS buang, sha1(coalesce(string_agg(b, '|' ORDER BY no) FILTER (NOT buang), '')) AS isi
    FROM nav GROUP BY 1""",
)
def nav_runs(spark, sf):
    d = _text_steps(_service(spark, sf)).withColumn("n", C.drop_navigation_runs(F.col("__b")))
    return d.select(
        "page_id", F.size("n.kept").alias("sisa"), F.col("n.dropped").alias("buang"),
        F.sha1(F.array_join("n.kept", "|")).alias("isi"),
    )


_BLOCK_STEPS = f"""
q AS (SELECT *, row_number() OVER (PARTITION BY page_id, lower({S.rep('b', S.WS + '+', ' ')}) ORDER BY no) AS ke FROM nav WHERE NOT buang),
h AS (SELECT page_id, no, b, length({S.ext('b', '^' + S.WS + '{0,3}(#{1,6})' + S.WS + '+')}) AS tingkat FROM q WHERE ke = 1),
lead AS (SELECT *, lead(tingkat) OVER (PARTITION BY page_id ORDER BY no) AS berikut FROM h),
fin AS (SELECT *, tingkat > 0 AND (berikut IS NULL OR (berikut > 0 AND berikut <= tingkat)) AS kosong FROM lead)
"""


@query(
    "clean_counts",
    f"""WITH {SERVICE_SQL}, {_TEXT_STEPS}, {_BLOCK_STEPS},
    s1 AS (SELECT page_id, count(*) FILTER (noise) AS baris_noise FROM n GROUP BY 1),
    s2 AS (SELECT page_id, count(*) FILTER (buang) AS blok_navigasi FROM nav GROUP BY 1),
    s3 AS (SELECT page_id, count(*) FILTER (ke > 1) AS blok_duplikat FROM q GROUP BY 1),
    s4 AS (SELECT page_id, count(*) FILTER (kosong) AS judul_kosong, string_agg(b, E'\\n\\n' ORDER BY no) FILTER (NOT kosong) AS md FROM fin GROUP BY 1)
    SELECT f.page_id, komentar, gambar, label_kosong, baris_noise, blok_navigasi, blok_duplikat, judul_kosong,
      sha256({S.norm_ws('md')}) AS bersih FROM f JOIN s1 USING (page_id) JOIN s2 USING (page_id) JOIN s3 USING (page_id) JOIN s4 USING (page_id)""",
)
def clean_counts(spark, sf):
    d = C.with_clean_markdown(_service(spark, sf), "md")
    return d.select("page_id", *C.COUNTERS, F.sha2("bersih", 256).alias("bersih"))


@query(
    "block_dedupe",
    f"""WITH {SERVICE_SQL}, {_TEXT_STEPS}, {_BLOCK_STEPS}
    SELECT page_id, count(*) AS blok, count(*) FILTER (ke > 1) AS ulang FROM q GROUP BY 1""",
)
def block_dedupe(spark, sf):
    d = _text_steps(_service(spark, sf)).withColumn("n", C.drop_navigation_runs(F.col("__b")))
    d = d.withColumn("u", C.first_of_each(F.col("n.kept")))
    return d.select(
        "page_id", F.size("n.kept").alias("blok"), (F.size("n.kept") - F.size("u")).alias("ulang")
    )


@query(
    "empty_headings",
    f"""WITH {SERVICE_SQL}, b AS (SELECT page_id, unnest(regexp_split_to_array({S.norm_ws('md')}, '\\n{{2,}}')) AS b,
        generate_subscripts(regexp_split_to_array({S.norm_ws('md')}, '\\n{{2,}}'), 1) AS no FROM svc),
    h AS (SELECT page_id, no, length({S.ext('b', '^' + S.WS + '{0,3}(#{1,6})' + S.WS + '+')}) AS t FROM b),
    l AS (SELECT *, lead(t) OVER (PARTITION BY page_id ORDER BY no) AS n FROM h)
    SELECT page_id, count(*) AS blok, count(*) FILTER (t > 0 AND (n IS NULL OR (n > 0 AND n <= t))) AS kosong FROM l GROUP BY 1""",
)
def empty_headings(spark, sf):
    d = _service(spark, sf).select("page_id", C.split_blocks(T.normalize_whitespace("md")).alias("b"))
    d = d.withColumn("k", C.drop_empty_headings(F.col("b")))
    return d.select("page_id", F.size("b").alias("blok"), (F.size("b") - F.size("k")).alias("kosong"))


@query(
    "boilerplate_lines",
    f"""WITH {SERVICE_SQL}, l AS (SELECT page_id, unnest(string_split({S.norm_ws('md')}, chr(10))) AS x,
        generate_subscripts(string_split({S.norm_ws('md')}, chr(10)), 1) AS i FROM svc),
    p0 AS MATERIALIZED (SELECT *, {S.plain_line('x')} AS p FROM l),
    p1 AS MATERIALIZED (SELECT *, {S.words('p')} AS kw FROM p0),
    n AS MATERIALIZED (SELECT page_id, i, x, {S.trim('x')} <> '' AND {S.noise('p', 'kw')} AS noise FROM p1),
    k AS (SELECT page_id, i, x, sum(CASE WHEN x = '' THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS g FROM n WHERE NOT noise),
    b AS (SELECT page_id, g, string_agg(x, chr(10) ORDER BY i) AS b FROM k WHERE x <> '' GROUP BY 1, 2),
    h AS (SELECT page_id, g, b, length({S.ext('b', '^' + S.WS + '{0,3}(#{1,6})' + S.WS + '+')}) AS t FROM b),
    e AS (SELECT *, lead(t) OVER (PARTITION BY page_id ORDER BY g) AS nx FROM h),
    z AS (SELECT *, t > 0 AND (nx IS NULL OR (nx > 0 AND nx <= t)) AS kosong FROM e),
    c AS (SELECT page_id, count(*) FILTER (kosong) AS kosong, string_agg(b, E'\\n\\n' ORDER BY g) FILTER (NOT kosong) AS md FROM z GROUP BY 1),
    s AS (SELECT page_id, count(*) FILTER (noise) AS noise FROM n GROUP BY 1)
    SELECT page_id, noise + kosong AS dihapus, sha256({S.norm_ws('md')}) AS isi FROM c JOIN s USING (page_id)""",
)
def boilerplate_lines(spark, sf):
    d = C.with_boilerplate_dropped(_service(spark, sf), "md", "isi", "dihapus")
    return d.select("page_id", "dihapus", F.sha2("isi", 256).alias("isi"))


@query(
    "cleaned_reduction",
    f"""WITH {SERVICE_SQL}, {_TEXT_STEPS}, {_BLOCK_STEPS},
    s AS (SELECT page_id, string_agg(b, E'\\n\\n' ORDER BY no) FILTER (NOT kosong) AS x FROM fin GROUP BY 1),
    t AS (SELECT page_id, length(svc.md) AS sebelum, length({S.norm_ws('x')}) AS sesudah FROM svc JOIN s USING (page_id))
    SELECT page_id, CASE WHEN sebelum <= 0 OR sesudah >= sebelum THEN '0%' ELSE
      round((1 - sesudah::DOUBLE / sebelum) * 100)::INT || '%' END AS berkurang FROM t""",
)
def cleaned_reduction(spark, sf):
    d = C.with_clean_markdown(_service(spark, sf), "md")
    return d.select("page_id", T.percent_reduced(F.length("md"), F.length("bersih")).alias("berkurang"))
