"""Queries over response, parse and job decisions, decoded bodies, file pairs and run counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import decisions as DE
from docloom.operators import report as R
from docloom.plans.registry import query
from docloom.session import table

_META = """regexp_replace(html, '(?i)<meta([^>]*?)charset\\s*=\\s*["'']?[a-z0-9_\\-]+["'']?', '<meta\\1charset="UTF-8"')"""


@query(
    "decode_bodies",
    f"""SELECT page_id, sha1(CASE page_id % 4 WHEN 3 THEN replace(html, '<meta charset="utf-8">', '') WHEN 2 THEN {_META} WHEN 1 THEN {_META} ELSE {_META} END) AS sidik
    FROM pages""",
)
def decode_bodies(spark, sf):
    """Pages as bytes: with a byte order mark, by header, by meta tag, and by what the bytes are."""
    n = F.col("page_id") % 4
    html = F.when(n == 2, F.replace("html", F.lit('charset="utf-8"'), F.lit('charset="windows-1252"'))).when(
        n == 3, F.replace("html", F.lit('<meta charset="utf-8">'), F.lit(""))).otherwise(F.col("html"))
    body = F.when(n == 0, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode(html, "UTF-8"))).otherwise(F.encode(html, "ISO-8859-1"))
    p = table(spark, sf, "pages").select("page_id", body.alias("body"), F.when(n == 1, F.lit("iso-8859-1")).alias("header"))
    return p.select("page_id", F.sha1(DE.decode_body("body", "header")).alias("sidik"))


@query(
    "document_response",
    """SELECT event_id, (event_id % 7 IN (0, 1, 2)) AND (event_id % 4 = 1 OR (event_id % 4 = 0 AND event_id % 3 = 0)) AS dokumen FROM events""",
)
def document_response(spark, sf):
    """Status, type and address each cycle; type counts first, the address only without a type."""
    e = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, (200, 302, 206, 404, 500, 101, 0))), (e % 7 + 1).cast("int"))
    kind = F.when(e % 4 == 1, F.lit("Application/PDF; charset=binary")).when(e % 4 == 2, F.lit("text/html")).when(e % 4 == 3, F.lit("image/png"))
    url = F.concat(F.lit("https://h.example/a"), F.when(e % 3 == 0, F.lit(".pdf?x=1")).otherwise(F.lit("/")))
    return table(spark, sf, "events").select("event_id", DE.is_document_response(status, kind, url).alias("dokumen"))


@query(
    "parse_acceptance",
    """SELECT doc_id, doc_id % 5 <> 0 AND trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(11)) <> '' AND (doc_id % 2 = 0 OR length(text) >= 400) AS diterima
    FROM documents""",
)
def parse_acceptance(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    return d.select("doc_id", DE.parse_accepted(i % 5 != 0, "text", i % 2 != 0, 400).alias("diterima"))


@query(
    "active_jobs",
    """SELECT o_orderkey, o_orderstatus IN ('O', 'P') AS aktif FROM orders""",
)
def active_jobs(spark, sf):
    s = F.col("o_orderstatus")
    status = F.when(s == "O", F.lit("berjalan")).when(s == "P", F.lit("Dijeda")).otherwise(F.lit("SELESAI"))
    return table(spark, sf, "orders").select("o_orderkey", DE.is_active_job(status).alias("aktif"))


@query(
    "allowed_extensions",
    """SELECT page_id, page_id % 3 = 0 AS pdf_saja, page_id % 3 < 2 AS semua FROM pages""",
)
def allowed_extensions(spark, sf):
    i = F.col("page_id")
    e = F.when(i % 3 == 0, F.lit(".PDF")).when(i % 3 == 1, F.lit(".docx")).otherwise(F.lit(".png"))
    url = F.concat(F.lit("https://h.example/f"), i.cast("string"), e)
    return table(spark, sf, "pages").select(
        "page_id", DE.extension_allowed(url, [" pdf", ""]).alias("pdf_saja"), DE.extension_allowed(url, []).alias("semua"))


@query(
    "file_pairs",
    """WITH f AS (SELECT page_id, 'h' || page_id || '--' || substr(sha1(url), 1, 8) AS b FROM pages)
    SELECT page_id, b || CASE page_id % 2 WHEN 0 THEN '.html' ELSE '.HTM' END AS berkas, CASE WHEN page_id % 3 = 0 THEN page_id END AS sumber FROM f""",
)
def file_pairs(spark, sf):
    """Stored pages and the markdown of the same name: an equi join on the derived name."""
    p = table(spark, sf, "pages")
    base = F.concat(F.lit("h"), F.col("page_id").cast("string"), F.lit("--"), F.substring(F.sha1("url"), 1, 8))
    raw = p.select("page_id", F.concat(base, F.when(F.col("page_id") % 2 == 0, F.lit(".html")).otherwise(F.lit(".HTM"))).alias("berkas"))
    md = p.filter("page_id % 3 = 0").select(F.concat(base, F.lit(".md")).alias("nama"), F.col("page_id").alias("sumber"))
    named = raw.withColumn("nama", DE.pair_name(F.concat(F.lit("/data/raw/"), "berkas")))
    return named.join(md, "nama", "left").select("page_id", "berkas", "sumber")


_KINDS = list(R.COUNTERS)
_KIND_SQL = "CASE (l_orderkey + l_linenumber) % 17 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"
_COUNTER_SQL = "SELECT l_suppkey, " + ", ".join(
    f"round(coalesce(sum(l_extendedprice::DECIMAL(18, 2)) FILTER (k = '{k}'), 0), 2)::DOUBLE AS {k}" if k == "durasi"
    else f"coalesce(sum(l_quantity) FILTER (k = '{k}'), 0)::BIGINT AS {k}" for k in _KINDS
) + f" FROM (SELECT *, {_KIND_SQL} AS k FROM lineitem) GROUP BY 1"


def _counters(spark, sf):
    at = ((F.col("l_orderkey") + F.col("l_linenumber")) % len(_KINDS) + 1).cast("int")
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), at)
    amount = F.when(kind == "durasi", F.col("l_extendedprice")).otherwise(F.col("l_quantity")).cast("decimal(18,2)")
    e = table(spark, sf, "lineitem").select("l_suppkey", kind.alias("kind"), amount.alias("n"))
    return R.run_counters(e, "l_suppkey", "kind", "n")


@query("run_counters", _COUNTER_SQL)
def run_counters(spark, sf):
    """All counters of each site (sites are suppliers, events are order lines)."""
    return _counters(spark, sf)


@query(
    "run_summary",
    f"""WITH c AS ({_COUNTER_SQL}) SELECT 'Site diproses' AS baris, count(*)::DOUBLE AS nilai FROM c """
    + " ".join(f"UNION ALL SELECT '{label}', sum({k})::DOUBLE FROM c" for k, label in R.COUNTERS.items()),
)
def run_summary(spark, sf):
    return R.summary_of(_counters(spark, sf))


@query(
    "discovery_log",
    """WITH c AS (SELECT n_name, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT lower(replace(n_name, ' ', '-')) || '.example' AS domain, count(*) FILTER (c_acctbal < 0)::INT AS jumlah_ditemukan, count(*) AS jumlah_kandidat,
      '{"domain":"' || lower(replace(n_name, ' ', '-')) || '.example","situs":[' ||
        coalesce(string_agg('{"host":"h' || c_custkey || '"}', ',' ORDER BY 'h' || c_custkey) FILTER (c_acctbal < 0), '') || ']}' AS log,
      '2024-01-01' AS created_at FROM c GROUP BY n_name""",
)
def discovery_log(spark, sf):
    """Searched domains are nations, hosts are customers, those in debt are the sites found."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))), F.lit(".example")).alias("domain"))
    c = table(spark, sf, "customer").join(n, "c_nationkey").select("domain", F.concat(F.lit("h"), F.col("c_custkey").cast("string")).alias("host"), "c_acctbal")
    return R.discovery_log(c.filter("c_acctbal < 0").select("domain", "host"), "domain", c, "2024-01-01")
