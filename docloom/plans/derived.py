"""Inputs of kinds, derived by Spark from the given tables.

The tables have no crawl logs, manifests or status rows, so these are projections of whole
tables into those shapes; every query over them grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import logs as L
from docloom.functions.text import let
from docloom.session import table


def doc_url():
    return F.concat(
        F.lit("https://"), "source", F.lit(".example.com/dokumen/"), F.col("doc_id").cast("string")
    )


def documents(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """The documents table, or ``rows`` of it (a stream), with addresses."""
    rows = table(spark, sf, "documents") if rows is None else rows
    return rows.select("doc_id", "source", "text", doc_url().alias("url"))


def page_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def sectioned(text):
    """Every line of a text becomes a page: heading ``Page <n>``, a titled heading, the line."""
    return F.array_join(
        F.transform(
            F.split(text, "\n"),
            lambda x, i: F.concat(
                F.lit("## Page "), (i + 1).cast("string"), F.lit("\n\n### Bagian "),
                F.element_at(F.split(x, " "), 1), F.lit("\n\n"), x,
            ),
        ),
        "\n\n",
    )


SECTIONED_SQL = """
array_to_string(list_transform(string_split(text, chr(10)),
  lambda x, i: '## Page ' || i || chr(10) || chr(10) || '### Bagian ' || string_split(x, ' ')[1]
    || chr(10) || chr(10) || x), chr(10) || chr(10))
"""


def log_lines(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """(pos, value): one run-log line per event; runs are hours, sites are users."""
    e = table(spark, sf, "events") if events is None else events
    stage = (
        F.when((F.col("event_type") == "view") & (F.col("value") < 3), F.lit("SITE_START"))
        .when(F.col("event_type") == "view", F.lit("FETCH_AFTER"))
        .when(F.col("event_type") == "click", F.lit("PARSE_AFTER"))
        .when(F.col("event_type") == "purchase", F.lit("EMBED_BATCH"))
        .when(F.col("event_type") == "signup", F.lit("DOC_AFTER"))
        .when(F.col("value") < 10, F.lit("RENDER_AFTER"))
        .otherwise(F.lit("RUN_END"))
    )
    run = F.concat(F.lit("RUN-"), F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000"))
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    status = F.when(F.col("event_id") % 7 == 0, F.lit("GAGAL")).otherwise(F.lit("SUKSES"))
    line = L.render_line(
        "ts",
        run,
        F.concat(F.lit("situs-"), user),
        stage,
        status,
        F.concat(F.lit("https://situs-"), user, F.lit(".example.com/hal/"), event),
        {
            "document_id": F.concat(F.lit("d-"), event),
            "judul": F.concat(F.lit("Judul "), event),
            "chunk": F.get_json_object("props", "$.k"),
            "vektor": F.floor("value").cast("string"),
            "durasi": F.concat(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("s")),
        },
        F.concat(F.lit("Tahap  selesai "), event),
    )
    return e.select(F.col("event_id").alias("pos"), line.alias("value"))


# the same rows as columns, for the check queries
LOG_SQL = """
log AS (
  SELECT event_id AS pos, ts, 'RUN-' || strftime(ts, '%Y%m%d-%H') || '0000' AS run_id,
    'situs-' || user_id AS site,
    CASE WHEN event_type = 'view' AND value < 3 THEN 'SITE_START'
         WHEN event_type = 'view' THEN 'FETCH_AFTER' WHEN event_type = 'click' THEN 'PARSE_AFTER'
         WHEN event_type = 'purchase' THEN 'EMBED_BATCH' WHEN event_type = 'signup' THEN 'DOC_AFTER'
         WHEN value < 10 THEN 'RENDER_AFTER' ELSE 'RUN_END' END AS stage,
    CASE WHEN event_id % 7 = 0 THEN 'GAGAL' ELSE 'SUKSES' END AS status,
    'https://situs-' || user_id || '.example.com/hal/' || event_id AS url,
    CAST(json_extract(props, '$.k') AS BIGINT) AS chunk, CAST(floor(value) AS BIGINT) AS vektor,
    CAST(value AS DECIMAL(18,2)) AS durasi
  FROM events)
"""


def manifests(spark: SparkSession, sf: str) -> DataFrame:
    """One manifest per order: site = nation of the customer, counts from its lines."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    q = F.col("l_quantity").cast("long")
    n = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count("*").alias("dokumen"),
            F.sum(q).alias("chunk"),
            F.sum(F.when(F.col("l_linestatus") == "F", q).otherwise(0)).alias("vektor"),
            F.sum(F.when(F.col("l_returnflag") == "N", q).otherwise(0)).alias("push_terkirim"),
            F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0)).alias("push_gagal"),
        )
    )
    run = F.concat(
        F.lit("RUN-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"),
        F.lpad((F.col("o_orderkey") % 240000).cast("string"), 6, "0"),
    )
    site = F.concat(F.lit("situs-"), F.col("c_nationkey").cast("string"))
    return (
        o.join(c, "o_custkey")
        .join(n, "o_orderkey", "left")
        .select(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("tanggal"),
            site.alias("site_id"),
            F.concat(F.lit("Situs "), F.col("c_nationkey").cast("string")).alias("site_name"),
            F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(run).alias("run_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dibuat"),
            *[
                F.coalesce(x, F.lit(0)).cast("long").alias(x)
                for x in ["dokumen", "chunk", "vektor", "push_terkirim", "push_gagal"]
            ],
            F.lit("SUKSES").alias("push"),
        )
    )


MANIFEST_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS dokumen, sum(l_quantity::BIGINT) AS chunk,
    sum(CASE WHEN l_linestatus = 'F' THEN l_quantity::BIGINT ELSE 0 END) AS vektor,
    sum(CASE WHEN l_returnflag = 'N' THEN l_quantity::BIGINT ELSE 0 END) AS push_terkirim,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END) AS push_gagal
  FROM lineitem GROUP BY 1),
manifests AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS tanggal, 'situs-' || c_nationkey AS site_id,
    'Situs ' || c_nationkey AS site_name,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'RUN-' || strftime(o_orderdate, '%Y%m%d') || '-'
      || lpad((o_orderkey % 240000)::VARCHAR, 6, '0') END AS run_id,
    coalesce(dokumen, 0)::BIGINT AS dokumen, coalesce(chunk, 0)::BIGINT AS chunk,
    coalesce(vektor, 0)::BIGINT AS vektor, coalesce(push_terkirim, 0)::BIGINT AS push_terkirim,
    coalesce(push_gagal, 0)::BIGINT AS push_gagal
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lines ON l_orderkey = o_orderkey)
"""


def status_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Status table as the customers would have it."""
    status = (
        F.when(F.col("c_acctbal") < 0, F.lit("failed_akses"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit("discovered"))
        .otherwise(F.lit("success"))
    )
    c = table(spark, sf, "customer")
    return c.select(
        F.concat(F.lit("https://"), F.lower("c_name"), F.lit(".example.com/")).alias("url"),
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("document_type"),
        status.alias("status"),
        F.lit("awal").alias("message"),
        F.lit("").alias("run_id"),
        F.date_format(F.lit("2024-01-01").cast("timestamp"), "yyyy-MM-dd").alias("last_crawled"),
    )


STATUS_SQL = """
existing AS (
  SELECT 'https://' || lower(c_name) || '.example.com/' AS url, c_custkey AS id,
    c_mktsegment AS document_type,
    CASE WHEN c_acctbal < 0 THEN 'failed_akses' WHEN c_mktsegment = 'BUILDING' THEN 'discovered'
      ELSE 'success' END AS status,
    'awal' AS message, '' AS run_id, '2024-01-01' AS last_crawled
  FROM customer)
"""


def status_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl outcomes in order: one per order for known sites, one per line for supplier sites."""
    o = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey"
    )
    known = o.select(
        F.concat(F.lit("https://"), F.lower("c_name"), F.lit(".example.com/")).alias("url"),
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("document_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("failed_akses"))
        .when(F.col("o_orderstatus") == "O", F.lit("success"))
        .otherwise(F.lit("lain"))
        .alias("status"),
        F.concat(F.lit("pesanan "), F.col("o_orderkey").cast("string")).alias("message"),
        F.concat(F.lit("RUN-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_crawled"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("seq"),
    )
    x = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"
    )
    new = x.select(
        F.concat(F.lit("https://"), F.lower("s_name"), F.lit(".example.com/")).alias("url"),
        F.col("l_suppkey").alias("id"),
        F.col("l_returnflag").alias("document_type"),
        F.when(F.col("l_linestatus") == "F", F.lit("failed_akses")).otherwise(F.lit("success")).alias("status"),
        F.concat(F.lit("baris "), F.col("l_linenumber").cast("string")).alias("message"),
        F.concat(F.lit("RUN-"), F.col("l_orderkey").cast("string")).alias("run_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("last_crawled"),
        # order and line number repeat in the data, so the rest of the row breaks ties
        F.concat_ws(
            "-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"),
            F.date_format("l_shipdate", "yyyy-MM-dd"), "l_returnflag", "l_linestatus",
        ).alias("seq"),
    )
    return known.unionByName(new)


UPDATES_SQL = """
updates AS (
  SELECT 'https://' || lower(c_name) || '.example.com/' AS url, o_custkey AS id,
    o_orderpriority AS document_type,
    CASE o_orderstatus WHEN 'F' THEN 'failed_akses' ELSE 'success' END AS status,
    'pesanan ' || o_orderkey AS message, 'RUN-' || o_orderkey AS run_id,
    strftime(o_orderdate, '%Y-%m-%d') AS last_crawled, lpad(o_orderkey::VARCHAR, 12, '0') AS seq
  FROM orders JOIN customer ON c_custkey = o_custkey
  UNION ALL
  SELECT 'https://' || lower(s_name) || '.example.com/', l_suppkey, l_returnflag,
    CASE WHEN l_linestatus = 'F' THEN 'failed_akses' ELSE 'success' END,
    'baris ' || l_linenumber, 'RUN-' || l_orderkey, strftime(l_shipdate, '%Y-%m-%d'),
    lpad(l_orderkey::VARCHAR, 12, '0') || '-' || l_linenumber || '-' || strftime(l_shipdate, '%Y-%m-%d') || '-' || l_returnflag || '-' || l_linestatus
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
"""


def service_markdown():
    """Markdown as a parse service would return it for a page: menus, images, repeats, footer."""
    labels = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), F.lit(2))
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), F.lit(1))
    paras = F.regexp_extract_all("html", F.lit("<p>(?:<b>)?([^<]+)"), F.lit(1))
    h1 = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    parts = F.struct(labels.alias("labels"), hrefs.alias("hrefs"), paras.alias("paras"), h1.alias("h1"))

    def composed(x):
        labels, hrefs, paras, h1 = x["labels"], x["hrefs"], x["paras"], x["h1"]
        nav = F.array_join(
            F.zip_with(
                labels, hrefs,
                lambda a, b: F.concat(F.lit("- ["), a, F.lit(" "), a, F.lit("...]("), F.translate(b, "/", "\\"), F.lit(")")),
            ),
            "\n",
        )
        return F.concat(
            F.lit("<!-- image -->\r\n[](kosong)"), nav, F.lit("\n\n[Unduh "), F.element_at(labels, 1),
            F.lit("](unduh.pdf)\n\n![logo](x.png)\n\n#### Tautan Cepat\n\n# "), h1, F.lit("\n\n"),
            F.array_join(F.transform(paras, lambda p, i: F.concat(p, F.when(i % 3 == 0, F.lit("\n3 / page")).otherwise(F.lit("")))), "\n\n"),
            F.lit("\n\n"), F.replace(F.element_at(paras, 1), F.lit(' '), F.lit('  ')), F.lit("\n\n"), F.element_at(paras, 1),
            F.lit("\n\n[Beranda Beranda](\\)\n\n## Kontak Kami Semua\n\nJl. Merdeka No. 7\n12\n\n© 2025 X\n\n(021) 3450038\n\n[Telp](tel:021)"),
        )

    return let(parts, composed)


SERVICE_SQL = """
svc AS (
  SELECT page_id, '<!-- image -->' || chr(13) || chr(10) || '[](kosong)' || array_to_string(list_transform(
      list_zip(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2), regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)),
      lambda z: '- [' || z[1] || ' ' || z[1] || '...](' || replace(z[2], '/', '\\') || ')'), chr(10))
    || chr(10) || chr(10) || '[Unduh ' || regexp_extract(html, '<a href="([^"]*)">([^<]*)</a>', 2) || '](unduh.pdf)'
    || E'\\n\\n![logo](x.png)\\n\\n#### Tautan Cepat\\n\\n# ' || regexp_extract(html, '<h1>([^<]*)</h1>', 1) || chr(10) || chr(10)
    || array_to_string(list_transform(regexp_extract_all(html, '<p>(?:<b>)?([^<]+)', 1),
      lambda p, i: p || CASE WHEN (i - 1) % 3 = 0 THEN E'\\n3 / page' ELSE '' END), E'\\n\\n')
    || E'\\n\\n' || replace(regexp_extract(html, '<p>(?:<b>)?([^<]+)', 1), ' ', '  ') || E'\\n\\n' || regexp_extract(html, '<p>(?:<b>)?([^<]+)', 1)
    || E'\\n\\n[Beranda Beranda](' || chr(92) || E')\\n\\n## Kontak Kami Semua\\n\\nJl. Merdeka No. 7\\n12\\n\\n© 2025 X\\n\\n(021) 3450038\\n\\n[Telp](tel:021)' AS md
  FROM pages)
"""
