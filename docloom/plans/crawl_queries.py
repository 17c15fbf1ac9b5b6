"""Queries over the frontier, recovery, JSON answers, discovery and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import urls as U
from docloom.operators import frontier as FR, jsonwalk as J, links as L, recovery as RC, rules as RU
from docloom.plans import sqltext as S
from docloom.plans.page_queries import _LINKS_SQL
from docloom.plans.registry import query
from docloom.plans.text_queries import sql_normalized
from docloom.session import table

# --- frontier --------------------------------------------------------------------

_GRAPH = """e AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem
  UNION SELECT DISTINCT 's' || l_suppkey, 'o' || l_orderkey FROM lineitem
  UNION SELECT DISTINCT 'o' || o_orderkey, 'c' || o_custkey FROM orders)"""


@query(
    "bfs_depth",
    f"""WITH RECURSIVE {_GRAPH}, seed AS (SELECT DISTINCT 'p' || arg_min(p_partkey, p_retailprice * 1000000 + p_partkey) AS n FROM part GROUP BY p_brand),
    b AS (SELECT n, 0 AS depth FROM seed UNION SELECT dst, depth + 1 FROM b JOIN e ON src = n WHERE depth < 5)
    SELECT n AS url, min(depth) AS depth FROM b GROUP BY 1""",
)
def bfs_depth(spark, sf):
    """Parts link to suppliers, suppliers to orders, orders to customers; seeds: a part per brand."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")

    def node(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    edges = li.select(node("p", "l_partkey").alias("src"), node("s", "l_suppkey").alias("dst"))
    edges = edges.unionByName(li.select(node("s", "l_suppkey").alias("src"), node("o", "l_orderkey").alias("dst")))
    edges = edges.unionByName(o.select(node("o", "o_orderkey").alias("src"), node("c", "o_custkey").alias("dst")))
    first = F.min_by("p_partkey", F.col("p_retailprice") * 1000000 + F.col("p_partkey"))
    seeds = table(spark, sf, "part").groupBy("p_brand").agg(first.alias("k")).select(node("p", "k").alias("url"))
    return FR.breadth_first(seeds, edges, 5)


def _page_links(spark, sf):
    return L.extract_links(table(spark, sf, "pages"), "page_id", "url", "html")


@query(
    "crawl_rounds",
    f"""WITH {_LINKS_SQL}, seed AS (SELECT DISTINCT {sql_normalized('url')} AS u FROM pages),
    a AS (SELECT u AS url, 0 AS depth FROM seed UNION ALL SELECT link, 1 FROM links)
    SELECT url, min(depth) AS depth FROM a GROUP BY 1""",
)
def crawl_rounds(spark, sf):
    """Frontier of the page table: its addresses, then the links found on them."""
    pages = U.with_normalized_url(table(spark, sf, "pages"), "url", "url", "src")
    seeds = pages.select(F.col("src").alias("url"))
    edges = _page_links(spark, sf).join(pages.select("page_id", "src"), "page_id")
    return FR.breadth_first(seeds, edges.select("src", F.col("link").alias("dst")), 3)


@query(
    "merge_frontier",
    f"""WITH {_LINKS_SQL}, a AS (SELECT {sql_normalized('url')} AS url, 0 AS depth FROM pages
      UNION ALL SELECT link, 1 FROM links UNION ALL SELECT {S.DOC_URL}, 1 FROM documents)
    SELECT url, min(depth) AS depth FROM a GROUP BY 1""",
)
def merge_frontier(spark, sf):
    from docloom.plans.derived import documents

    pages = U.with_normalized_url(table(spark, sf, "pages"), "url", "url", "u").select(F.col("u").alias("url"), F.lit(0).alias("depth"))
    links = _page_links(spark, sf).select(F.col("link").alias("url"), F.lit(1).alias("depth"))
    docs = documents(spark, sf).select("url", F.lit(1).alias("depth"))
    return FR.merge_frontier(pages, links, docs)


@query(
    "frontier_priority",
    """WITH f AS (SELECT event_id, event_type = 'purchase' AS d FROM events),
    r AS (SELECT event_id, row_number() OVER (ORDER BY d DESC, event_id) AS urutan FROM f)
    SELECT event_id, urutan, urutan <= 2500 AS diambil FROM r""",
)
def frontier_priority(spark, sf):
    """Documents jump the queue; the page budget marks what this run takes."""
    f = table(spark, sf, "events").select("event_id", (F.col("event_type") == "purchase").alias("is_document"))
    return FR.by_priority(f, "event_id", 2500).select("event_id", "urutan", "diambil")


@query(
    "host_gate",
    f"""WITH h AS (SELECT {S.host('url')} AS host, min(page_id) AS pertama, count(*) AS tautan FROM pages GROUP BY 1)
    SELECT host, pertama, tautan FROM h ORDER BY pertama, host LIMIT 20""",
)
def host_gate(spark, sf):
    p = table(spark, sf, "pages").select("page_id", U.host("url").alias("host"))
    return FR.open_hosts(p, "host", "page_id", 20)


@query(
    "depth_gate",
    "SELECT l_linenumber AS depth, count(*) AS tautan, l_linenumber < 4 AS boleh FROM lineitem GROUP BY 1",
)
def depth_gate(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("depth")).agg(F.count("*").alias("tautan"))
    return li.withColumn("boleh", FR.depth_allowed("depth", 4))


@query(
    "new_links",
    f"""WITH {_LINKS_SQL}, seen AS (SELECT DISTINCT {S.ext('link', '^[a-z]+://[^/]+(/.*)$')} AS p FROM links WHERE page_id % 2 = 0),
    n AS (SELECT DISTINCT {S.ext('link', '^[a-z]+://[^/]+(/.*)$')} AS p FROM links)
    SELECT p FROM n WHERE p NOT IN (SELECT p FROM seen)""",
)
def new_links(spark, sf):
    """Paths first met on odd pages: the anti join of a crawl round."""
    d = _page_links(spark, sf).select("page_id", U.path("link").alias("p"))
    seen = d.filter(F.col("page_id") % 2 == 0).select("p").distinct()
    return d.select("p").distinct().join(seen, "p", "left_anti")


# --- recovery --------------------------------------------------------------------

_FILES = f"""cand AS (SELECT page_id AS seq, url, 'html' AS sumber, 2 AS r FROM pages WHERE page_id % 7 <> 0
    UNION ALL SELECT page_id, url, 'markdown', 1 FROM pages WHERE page_id % 3 = 0
    UNION ALL SELECT page_id, url, 'url', 0 FROM pages WHERE page_id % 11 = 0),
  form AS (SELECT seq, sumber, r, 0 AS f, url AS u FROM cand UNION ALL SELECT seq, sumber, r, 1, {sql_normalized('url')} FROM cand),
  best AS (SELECT substr({S.uuid5('u')}, 1, 8) AS h, arg_min((u, sumber), (r, seq, f)) AS c FROM form GROUP BY 1),
  file AS (SELECT page_id, substr({S.uuid5(sql_normalized('url'))}, 1, 8) AS h FROM pages)"""


def _recovery(spark, sf):
    p = U.with_normalized_url(table(spark, sf, "pages"), "url", "url", "n")
    files = p.select("page_id", U.document_file_name("n", "pdf").alias("nama"))
    i = F.col("page_id")

    def source(cond, name):
        return p.filter(cond).select("url", F.lit(name).alias("sumber"), i.alias("seq"))

    c = source(i % 7 != 0, "html").unionByName(source(i % 3 == 0, "markdown")).unionByName(source(i % 11 == 0, "url"))
    return files, RC.candidates(c)


@query(
    "recover_urls",
    f"""WITH {_FILES} SELECT page_id, c[1] AS url, c[2] AS sumber FROM file JOIN best USING (h)""",
)
def recover_urls(spark, sf):
    files, c = _recovery(spark, sf)
    return RC.match_files(files, c)[0].select("page_id", "url", "sumber")


@query(
    "files_without_url",
    f"WITH {_FILES} SELECT page_id FROM file WHERE h NOT IN (SELECT h FROM best)",
)
def files_without_url(spark, sf):
    files, c = _recovery(spark, sf)
    return RC.match_files(files, c)[1].select("page_id")


@query(
    "pending_priority",
    f"""WITH {_FILES}, i AS (SELECT page_id, CASE c[2] WHEN 'url' THEN 0 WHEN 'markdown' THEN 1 ELSE 2 END AS prioritas,
      ({S.slug(S.label(sql_normalized('url')), 80)}) || '--' || h || '.pdf' AS nama FROM file JOIN best USING (h) JOIN pages USING (page_id))
    SELECT page_id, prioritas, nama FROM i ORDER BY prioritas, nama LIMIT 100""",
)
def pending_priority(spark, sf):
    files, c = _recovery(spark, sf)
    items = RC.plan_items(RC.match_files(files, c)[0], 100)
    return items.select("page_id", "prioritas", "nama")


@query(
    "not_yet_processed",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def not_yet_processed(spark, sf):
    return RC.not_yet_processed(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


# --- JSON answers ----------------------------------------------------------------


@query("json_dig", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_dig(spark, sf):
    return table(spark, sf, "events").select("event_id", J.dig("props", "k").cast("long").alias("k"))


def _answers(spark, sf):
    """One JSON answer per page: nested items, relative and absolute files, noise fields."""
    i = F.col("page_id").cast("string")
    child = F.struct(
        F.lit("Anak").alias("nama"), F.concat(F.lit("https://x.example/unduh?id="), i).alias("link"),
        F.array(F.concat(F.lit("lampiran/"), i, F.lit(".docx")), F.lit("bukan berkas")).alias("daftar"),
    )
    item = F.struct(
        F.lit("file").alias("type"), F.concat(F.lit("Judul "), i).alias("judul"),
        F.concat(F.lit("/files/"), i, F.lit(".pdf")).alias("file"), F.array(child).alias("children"),
    )
    doc = F.struct(F.lit("ok").alias("status"), F.array(item).alias("data"), F.lit(5).alias("jumlah"))
    return table(spark, sf, "pages").select("page_id", "url", F.to_json(doc).alias("badan"))


@query(
    "json_walk_files",
    """SELECT page_id, '/files/' || page_id || '.pdf' AS url, 'Judul ' || page_id AS judul FROM pages
    UNION ALL SELECT page_id, 'https://x.example/unduh?id=' || page_id, 'Anak' FROM pages
    UNION ALL SELECT page_id, '/lampiran/' || page_id || '.docx', 'bukan berkas' FROM pages""",
)
def json_walk_files(spark, sf):
    return J.json_files(_answers(spark, sf), "page_id", "badan")


def _mixed_answers(spark, sf):
    """JSON answers whose fields are not in name order: nested objects, lists, numbers, unnamed titles."""
    i = F.col("page_id").cast("string")
    inner = F.struct(
        F.concat(F.lit("Zona "), i).alias("zeta"), F.concat(F.lit("Alfa "), i).alias("alpha"), F.concat(F.lit("/x/"), i, F.lit(".pdf")).alias("f"),
        F.struct(F.array(F.concat(F.lit("/y/"), i, F.lit(".xlsx")), F.concat(F.lit("/x/"), i, F.lit(".pdf"))).alias("b")).alias("a"),
    )
    doc = F.struct(
        F.struct(F.struct(F.array(inner).alias("isi")).alias("z")).alias("y"), F.lit(5.0).alias("n"), F.lit(1e20).alias("besar"),
        F.struct(F.lit("url").alias("type"), F.concat(F.lit("Beta "), i).alias("ket"), F.concat(F.lit("https://x.example/x/"), i, F.lit(".pdf")).alias("link")).alias("b"),
    )
    return table(spark, sf, "pages").select("page_id", "url", F.to_json(doc).alias("badan"))


@query(
    "json_walk_order",
    """SELECT page_id, '/x/' || page_id || '.pdf' AS url, 'Zona ' || page_id AS judul FROM pages
    UNION ALL SELECT page_id, '/y/' || page_id || '.xlsx', '' FROM pages
    UNION ALL SELECT page_id, 'https://x.example/x/' || page_id || '.pdf', 'Beta ' || page_id FROM pages""",
)
def json_walk_order(spark, sf):
    """The title is the first readable field of the object, in document order, at any depth."""
    return J.json_files(_mixed_answers(spark, sf), "page_id", "badan")


@query(
    "json_numbers",
    """SELECT page_id, 'Zona ' || page_id || E'\\n\\nAlfa ' || page_id || E'\\n\\n/x/' || page_id || E'.pdf\\n\\n/y/' || page_id || E'.xlsx\\n\\n/x/' || page_id
      || E'.pdf\\n\\n5\\n\\n1.0E+20\\n\\nurl\\n\\nBeta ' || page_id || E'\\n\\nhttps://x.example/x/' || page_id || '.pdf' AS teks FROM pages""",
)
def json_numbers(spark, sf):
    return _mixed_answers(spark, sf).select("page_id", J.flatten_json("badan", max_depth=None).alias("teks"))


@query(
    "document_rules",
    """SELECT page_id, 'https://dok.example/x/' || page_id || '.pdf' AS url, 'Zona ' || page_id AS judul FROM pages
    UNION ALL SELECT page_id, 'https://x.example/b/' || page_id || '.docx', '' FROM pages
    UNION ALL SELECT page_id, 'https://dok.example/c/' || page_id || '.pdf', '7' FROM pages""",
)
def document_rules(spark, sf):
    """Items, children, links and titles by the dotted paths of a rule; other extensions stay out."""
    i = F.col("page_id").cast("string")
    leaf = F.struct(F.struct(F.concat(F.lit("c/"), i, F.lit(".pdf")).alias("file")).alias("attr"), F.lit(7.0).alias("name"))
    second = F.struct(F.struct(F.concat(F.lit("https://x.example/b/"), i, F.lit(".docx")).alias("file")).alias("attr"), F.array(leaf).alias("kids"))
    item = F.struct(F.concat(F.lit("Zona "), i).alias("name"), F.struct(F.concat(F.lit("/x/"), i, F.lit(".pdf")).alias("file")).alias("attr"), F.array(second).alias("kids"))
    other = F.struct(F.struct(F.concat(F.lit("/x/"), i, F.lit(".zip")).alias("file")).alias("attr"))
    again = F.struct(F.lit("Lain").alias("name"), F.struct(F.concat(F.lit("/x/"), i, F.lit(".pdf")).alias("file")).alias("attr"))
    body = F.to_json(F.struct(F.struct(F.struct(item.alias("a"), other.alias("b"), again.alias("c")).alias("rows")).alias("data")))
    rule = {
        "items_field": "data.rows", "children_field": "kids", "link_field": "attr.file", "title_field": "name",
        "base_url": "https://dok.example/", "extensions": ["pdf", "DOCX "],
    }
    p = table(spark, sf, "pages").select("page_id", "url", body.alias("badan"))
    return J.rule_files(p, "page_id", "badan", "url", rule)


@query(
    "rule_groups_all",
    r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)', ['a', 'b', 'c', 'd']).b || '|' ||
      regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)', ['a', 'b', 'c', 'd']).d AS grup,
      CASE WHEN regexp_matches(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)') THEN 'https://api.example/' || regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)', 3) || '/'
        || regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)', 4) ELSE '' END AS endpoint FROM pages""",
)
def rule_groups_all(spark, sf):
    """A rule with four groups and a named one of Java's own syntax; the template uses the last two."""
    patterns = [r"^(https?)://([^/(]+)/(?<bahasa>[a-z]{2})/([0-9]++)"]
    g = RU.rule_groups("url", patterns)
    return table(spark, sf, "pages").select(
        "page_id", F.concat_ws("|", F.coalesce(F.get(g, F.lit(1)), F.lit("")), F.coalesce(F.get(g, F.lit(3)), F.lit(""))).alias("grup"),
        J.fill_endpoint(F.lit("https://api.example/{3}/{4}"), "url", g).alias("endpoint"),
    )


@query(
    "json_flatten",
    """SELECT page_id, 'ok' || E'\\n\\nfile\\n\\nJudul ' || page_id || E'\\n\\n/files/' || page_id || E'.pdf\\n\\nAnak\\n\\nhttps://x.example/unduh?id='
      || page_id || E'\\n\\n5' AS teks FROM pages""",
)
def json_flatten(spark, sf):
    """Text four levels down; the list inside a child lies deeper and is left out."""
    return _answers(spark, sf).select("page_id", J.flatten_json("badan").alias("teks"))


@query(
    "endpoint_fill",
    f"""WITH p AS (SELECT page_id, url, {S.path('url')} AS path, {S.host('url')} AS host, {S.url_query('url')} AS q FROM pages),
    s AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg FROM p)
    SELECT page_id, 'https://api.' || host || '/v1/' || regexp_replace(seg[-1], '(?i)[.][a-z0-9]{{1,5}}$', '') || '?p=' || array_to_string(seg, '/') || '&q=' || q || '&g=' || regexp_extract(url, '/([a-z]{{2}})/', 1) AS endpoint,
      '' AS salah, 'https://' || host || '/files/' || page_id || '.pdf' AS berkas FROM s""",
)
def endpoint_fill(spark, sf):
    p = table(spark, sf, "pages")
    groups = RU.rule_groups("url", ["/([a-z]{2})/"])
    return p.select(
        "page_id",
        J.fill_endpoint(F.lit("https://api.{host}/v1/{slug}?p={path}&q={query}&g={1}"), "url", groups).alias("endpoint"),
        J.fill_endpoint(F.lit("https://api/{lain}"), "url").alias("salah"),
        J.file_url(
            F.concat(F.lit("files/"), F.col("page_id").cast("string"), F.lit(".pdf")), F.lit(" "),
            F.concat(F.lit("https://"), U.host("url"), F.lit("/api/x?y=1")),
        ).alias("berkas"),
    )


@query(
    "rule_match",
    f"""SELECT page_id, CASE WHEN {S.match('url', '(?i)/EN/([0-9]+)')} THEN 1 WHEN {S.match('url', '(?i)[.]html')} THEN 2 WHEN {S.match('url', '(?i)^https:')} THEN 3 END AS aturan,
      CASE WHEN {S.match('url', '(?i)/EN/([0-9]+)')} THEN {S.ext('url', '(?i)/EN/([0-9]+)')} END AS grup FROM pages""",
)
def rule_match(spark, sf):
    patterns = ["/EN/([0-9]+)", r"\.html", "^https:"]
    g = RU.rule_groups("url", patterns)
    return table(spark, sf, "pages").select(
        "page_id", RU.first_rule("url", patterns).alias("aturan"), F.get(g, F.lit(0)).alias("grup")
    )


@query(
    "network_log",
    f"""WITH l AS (SELECT page_id, {S.host('url')} AS h FROM pages)
    SELECT page_id, 'https://cdn.other.net/a' || page_id || '.pdf' AS url, 'berkas' AS jenis, false AS utama FROM l
    UNION ALL SELECT page_id, 'https://' || h || '/unduh/' || page_id, 'berkas', false FROM l
    UNION ALL SELECT page_id, 'https://' || h || '/api/daftar?x=1&y=2', 'api', true FROM l""",
)
def network_log(spark, sf):
    h, i = U.host("url"), F.col("page_id").cast("string")
    log = F.concat(
        F.lit('{"u":"https://cdn.other.net/a'), i, F.lit('.pdf"},{"u":"https://'), h, F.lit("/unduh/"), i,
        F.lit('"},{"u":"https://'), h, F.lit('/api/daftar?x=1&amp;y=2"},{"u":"https://'), h,
        F.lit('/app.js"},{"u":"https://'), h, F.lit('/visitor/ping"},{"u":"https://'), h,
        F.lit('/"},{"u":"https://lain.test/api/a"},{"u":"'), F.col("url"), F.lit('"}'),
    )
    p = table(spark, sf, "pages").select("page_id", "url", log.alias("log"))
    return J.network_log_urls(p, "page_id", "log", "url")


@query(
    "certificate_hosts",
    f"""WITH d AS (SELECT page_id, CASE WHEN {S.host('url')} LIKE '%.example.com' THEN 'example.com' ELSE 'example.org' END AS d FROM pages)
    SELECT page_id, 'a.' || d AS host FROM d UNION ALL SELECT page_id, 'b' || page_id || '.' || d FROM d""",
)
def certificate_hosts(spark, sf):
    dom = F.when(U.host("url").endswith(".example.com"), F.lit("example.com")).otherwise(F.lit("example.org"))
    i = F.col("page_id").cast("string")
    entry = F.struct(
        F.concat(F.lit("*.a."), dom, F.lit("\nB"), i, F.lit("."), dom, F.lit("\nlain.net\n"), dom).alias("name_value"),
        F.concat(F.lit("a."), dom).alias("common_name"),
    )
    p = table(spark, sf, "pages").select("page_id", dom.alias("d"), F.to_json(F.array(entry)).alias("j"))
    return J.certificate_hosts(p, "page_id", "j", "d")


@query(
    "candidate_hosts",
    f"""WITH p AS (SELECT unnest({[''] + K.DISCOVERY_PREFIXES}) AS p, generate_subscripts({[''] + K.DISCOVERY_PREFIXES}, 1) AS o),
    d AS (SELECT DISTINCT lower(replace(n_name, ' ', '')) || '.test' AS domain FROM nation),
    r AS (SELECT domain, p || '.' || domain AS host, row_number() OVER (PARTITION BY domain ORDER BY o) AS rn FROM d, p WHERE p <> '')
    SELECT domain, host FROM r WHERE rn <= 20""",
)
def candidate_hosts(spark, sf):
    d = table(spark, sf, "nation").select(
        F.concat(F.lower(F.replace("n_name", F.lit(" "), F.lit(""))), F.lit(".test")).alias("domain")
    ).distinct()
    return J.candidate_hosts(d, "domain", None, 20)


@query(
    "candidate_hosts_cert",
    f"""WITH p AS (SELECT unnest({K.DISCOVERY_PREFIXES}) AS p),
    d AS (SELECT n_nationkey, lower(replace(n_name, ' ', '')) || '.test' AS domain FROM nation)
    SELECT domain, p || '.' || domain AS host FROM d, p UNION SELECT domain, 'h' || (c_custkey % 50) || '.' || domain FROM d JOIN customer ON c_nationkey = n_nationkey
    UNION SELECT domain, '{K.DISCOVERY_PREFIXES[0]}.' || domain FROM d""",
)
def candidate_hosts_cert(spark, sf):
    """Heuristic and certificate hosts together, each once, without a limit."""
    domain = F.concat(F.lower(F.replace("n_name", F.lit(" "), F.lit(""))), F.lit(".test"))
    d = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), domain.alias("domain"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.concat(F.lit("h"), (F.col("c_custkey") % 50).cast("string"), F.lit(".")).alias("h"))
    cert = d.join(c, "k").select("domain", F.concat("h", "domain").alias("host"))
    cert = cert.unionByName(d.select("domain", F.concat(F.lit(K.DISCOVERY_PREFIXES[0] + "."), "domain").alias("host")))
    return J.candidate_hosts(d.select("domain").distinct(), "domain", cert, 0)


@query(
    "folder_listing",
    """WITH f AS (SELECT page_id, md5(url) AS a, md5(url || 'x') AS b FROM pages)
    SELECT page_id, a AS id, 'Laporan & ' || page_id AS nama FROM f UNION ALL SELECT page_id, b, 'Dua.pdf' FROM f""",
)
def folder_listing(spark, sf):
    a, b = F.md5("url"), F.md5(F.concat("url", F.lit("x")))
    html = F.concat(
        F.lit('<div id="entry-'), a, F.lit('"><div class="flip-entry-title">Laporan &amp; '),
        F.col("page_id").cast("string"), F.lit('</div></div>\n<div id="entry-'), a,
        F.lit('"><p class="flip-entry-title">Ulang</p></div><script>window[\'_DRIVE_ivd\'] = \'[["'), b,
        F.lit('",["induk12345"],"Dua.pdf","application/pdf"]]\';</script>'),
    )
    d = table(spark, sf, "pages").select("page_id", F.explode(J.folder_files(html)).alias("f"))
    return d.select("page_id", "f.id", "f.nama")


# --- joins and sets ----------------------------------------------------------------


@query(
    "family_links",
    f"""WITH h AS (SELECT page_id, {S.host('url')} AS host, array_to_string(string_split({S.host('url')}, '.')[-2:], '.') AS dom FROM pages)
    SELECT page_id, host FROM h WHERE dom IN (SELECT dom FROM h GROUP BY 1 HAVING count(DISTINCT host) > 1)""",
)
def family_links(spark, sf):
    """Pages on hosts whose registrable domain serves more than one host."""
    h = table(spark, sf, "pages").select("page_id", U.host("url").alias("host"))
    h = h.withColumn("dom", U.registrable_domain("host"))
    fam = h.groupBy("dom").agg(F.min("host").alias("a"), F.max("host").alias("b")).filter("a <> b")
    return h.join(fam.select("dom"), "dom", "left_semi").select("page_id", "host")


@query(
    "title_lookup",
    f"""WITH t AS (SELECT doc_id, arg_min(quality, quality) AS quality FROM labels GROUP BY 1)
    SELECT d.doc_id, coalesce('Mutu ' || quality, 'tanpa label') AS judul FROM documents d LEFT JOIN t USING (doc_id)""",
)
def title_lookup(spark, sf):
    t = table(spark, sf, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    d = table(spark, sf, "documents").select("doc_id").join(t, "doc_id", "left")
    return d.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("Mutu "), F.col("quality").cast("string")), F.lit("tanpa label")).alias("judul"),
    )


@query(
    "semi_selected",
    "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)",
)
def semi_selected(spark, sf):
    chosen = table(spark, sf, "labels").filter("toxic = 0")
    return table(spark, sf, "documents").select("doc_id").join(chosen, "doc_id", "left_semi")


@query(
    "except_set",
    "SELECT DISTINCT c_nationkey AS k FROM customer EXCEPT SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal < 0",
)
def except_set(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    s = table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.col("s_nationkey").alias("k"))
    return c.join(s, "k", "left_anti")


@query(
    "intersect_set",
    f"""WITH a AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM benchmark),
    b AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM conversations)
    SELECT w FROM a INTERSECT SELECT w FROM b""",
)
def intersect_set(spark, sf):
    def words(t):
        return table(spark, sf, t).select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("w")).distinct()

    return words("benchmark").intersect(words("conversations"))


@query(
    "strict_lookup",
    """WITH w AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' || upper(c_name) || ' ' WHEN o_orderkey % 3 = 1 THEN o_custkey::VARCHAR
      ELSE 'tidak-ada-' || o_orderkey END AS cari, o_custkey FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey, o_orderkey % 3 <> 2 AS ditemukan, CASE WHEN o_orderkey % 3 <> 2 THEN o_custkey END AS c_custkey FROM w""",
)
def strict_lookup(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").join(c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    k = F.col("o_orderkey") % 3
    wanted = o.select(
        "o_orderkey",
        F.when(k == 0, F.concat(F.lit(" "), F.upper("c_name"), F.lit(" ")))
        .when(k == 1, F.col("o_custkey").cast("string"))
        .otherwise(F.concat(F.lit("tidak-ada-"), F.col("o_orderkey").cast("string")))
        .alias("cari"),
    )
    f = RU.find_strictly(wanted, c, "cari", ["c_custkey", "c_name"])
    return f.select("o_orderkey", "ditemukan", F.col("entri.c_custkey").alias("c_custkey"))


@query(
    "host_labels",
    f"""SELECT {S.host('url')} AS host, {S.rep(S.host('url'), '^www[.]', '', '')} AS nama, count(*) AS halaman,
      max(length({S.ext('url', '[^/]+$', 0)})) AS terpanjang FROM pages GROUP BY 1""",
)
def host_labels(spark, sf):
    p = table(spark, sf, "pages")
    return p.groupBy(U.host("url").alias("host")).agg(
        F.min(U.discovery_domain("url")).alias("nama"), F.count("*").alias("halaman"),
        F.max(F.length(F.regexp_extract("url", "[^/]+$", 0))).alias("terpanjang"),
    )
