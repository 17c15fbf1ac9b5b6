"""Queries over files named by services, shared folders, the frontier's budget and job states."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import urls as U
from docloom.operators import contentapi as A, frontier as FR, harvest as H, jobstates as J
from docloom.plans import sqltext as S
from docloom.plans.derived import documents
from docloom.plans.registry import query
from docloom.session import table


@query(
    "harvest_bases",
    f"""WITH p AS (SELECT page_id, {S.host('url')} AS host, {S.path('url')} || '.pdf' AS path FROM pages),
    known AS (SELECT DISTINCT CASE page_id % 3 WHEN 0 THEN 'https://api.' || host || '/uploads' || path WHEN 1 THEN 'https://' || host || path
      ELSE 'https://' || host || '/storage' || path END AS url FROM p),
    f AS (SELECT DISTINCT ON (page_id) *, string_split(ltrim(path, '/'), '/')[1] AS segmen FROM p),
    c AS (SELECT f.*, o * 3 + s AS urutan, h || x AS base FROM f,
      (VALUES (0, 'https://api.'), (1, 'https://')) a(o, pre), (VALUES (0, ''), (1, '/uploads'), (2, '/storage')) b(s, x), LATERAL (SELECT pre || host AS h)),
    votes AS (SELECT host, segmen, urutan, base, count(*) AS suara FROM c JOIN known ON known.url = base || path GROUP BY 1, 2, 3, 4),
    best AS (SELECT host, segmen, arg_max(base, suara * 10 - urutan) AS base, max(suara) AS suara FROM votes GROUP BY 1, 2)
    SELECT f.page_id, f.path, best.base, best.suara FROM f LEFT JOIN best USING (host, segmen)""",
)
def harvest_bases(spark, sf):
    """Every page names a file by its path; known addresses say where such files lie."""
    p = table(spark, sf, "pages").select("page_id", U.host("url").alias("host"), F.concat(U.path("url"), F.lit(".pdf")).alias("path"))
    site, third = F.concat(F.lit("https://"), "host"), F.col("page_id") % 3
    known = p.select(
        F.when(third == 0, F.concat(F.lit("https://api."), "host", F.lit("/uploads"), "path"))
        .when(third == 1, F.concat(site, "path")).otherwise(F.concat(site, F.lit("/storage"), "path")).alias("url"))
    files = p.select("page_id", "host", "path", F.concat(F.lit("https://api."), "host", F.lit("/v1/list")).alias("api_url"), F.concat(site, F.lit("/")).alias("page_url"))
    return H.resolve_bases(files, known, "host").select("page_id", "path", "base", "suara")


@query(
    "drive_members",
    """WITH RECURSIVE listing AS (
      SELECT 'r' || n_regionkey AS folder, 'n' || n_nationkey AS id, n_name AS nama, 'folder' AS jenis FROM nation
      UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'naik', 'folder' FROM nation
      UNION ALL SELECT 'r' || r_regionkey, 'r' || (r_regionkey + 1) % 5, r_name, 'folder' FROM region
      UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, c_name, 'berkas' FROM customer),
    w AS (SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS di, ['r' || r_regionkey] AS lewat, []::VARCHAR[] AS jalur FROM region
      UNION ALL SELECT root, l.id, list_append(lewat, l.id), list_append(jalur, l.nama) FROM w JOIN listing l ON l.folder = w.di
        AND l.jenis = 'folder' AND NOT list_contains(lewat, l.id))
    SELECT root, l.id, l.nama, array_to_string(jalur, '/') AS jalur FROM w JOIN listing l ON l.folder = w.di AND l.jenis = 'berkas'""",
)
def drive_members(spark, sf):
    """Regions hold nations, the next region and, through links back up, themselves; customers are the files."""
    def ref(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    n, r, c = (table(spark, sf, t) for t in ("nation", "region", "customer"))
    folder, file = F.lit("folder").alias("jenis"), F.lit("berkas").alias("jenis")
    after = F.concat(F.lit("r"), ((F.col("r_regionkey") + 1) % 5).cast("string"))
    listing = n.select(ref("r", "n_regionkey").alias("folder"), ref("n", "n_nationkey").alias("id"), F.col("n_name").alias("nama"), folder)
    listing = listing.unionByName(n.select(ref("n", "n_nationkey").alias("folder"), ref("r", "n_regionkey").alias("id"), F.lit("naik").alias("nama"), folder))
    listing = listing.unionByName(r.select(ref("r", "r_regionkey").alias("folder"), after.alias("id"), F.col("r_name").alias("nama"), folder))
    listing = listing.unionByName(c.select(ref("n", "c_nationkey").alias("folder"), ref("c", "c_custkey").alias("id"), F.col("c_name").alias("nama"), file))
    found = H.folder_members(r.select(ref("r", "r_regionkey").alias("folder")), listing)
    return found.select("root", "id", "nama", F.array_join("jalur", "/").alias("jalur"))


@query(
    "api_frontier",
    f"""WITH files AS (SELECT {S.DOC_URL} AS url, source || '.example.com' AS host, lang AS judul, doc_id AS no FROM documents),
    ok AS (SELECT url, 1 AS depth, true AS is_document, judul, no FROM files
      WHERE NOT (CAST(substr(host, 4, position('.' IN host) - 4) AS INT) % 3 = 0 AND starts_with(url, 'https://' || host || '/dokumen/1') AND NOT starts_with(url, 'https://' || host || '/dokumen/12'))),
    links AS (SELECT url, 2 AS depth, url LIKE '%/en/%' AS is_document, NULL AS judul, page_id AS no FROM pages
      UNION ALL SELECT {S.DOC_URL}, 0, false, NULL, doc_id FROM documents WHERE lang = 'fr'),
    a AS (SELECT * FROM ok UNION ALL SELECT * FROM links),
    visited AS (SELECT {S.DOC_URL} AS url FROM documents WHERE lang = 'de')
    SELECT url, min(depth) AS depth, bool_or(is_document) AS is_document, max(judul) AS judul,
      arg_min(no, (NOT is_document)::INT * 1e9 + no) AS no FROM a WHERE url NOT IN (SELECT url FROM visited) GROUP BY url""",
)
def api_frontier(spark, sf):
    """Documents are the files a service names, pages the links; every third host keeps a part of its files closed."""
    d = documents(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    files = d.select("url", F.col("lang").alias("judul"), F.col("doc_id").alias("no"))
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int")
    rule = F.array(
        F.struct(F.lit(False).alias("allow"), F.lit("/dokumen/1").alias("path"), F.lit(1).alias("rule_no")),
        F.struct(F.lit(True).alias("allow"), F.lit("/dokumen/12").alias("path"), F.lit(2).alias("rule_no")))
    closed = number % 3 == 0
    robots = d.select("source").distinct().filter(closed).select(F.concat("source", F.lit(".example.com")).alias("host"), rule.alias("rules"))
    links = table(spark, sf, "pages").select("url", F.lit(2).alias("depth"), F.col("url").contains("/en/").alias("is_document"), F.col("page_id").alias("no"))
    links = links.unionByName(d.filter("lang = 'fr'").select("url", F.lit(0).alias("depth"), F.lit(False).alias("is_document"), F.col("doc_id").alias("no")))
    return H.api_frontier(files, links, robots, d.filter("lang = 'de'").select("url"))


BUDGET, ROUNDS = 40, 4


def _budget_sql() -> str:
    """Rounds written out one after the other; every table names its own round."""
    parts = [f"""edges AS MATERIALIZED (SELECT DISTINCT src, dst, 'k' || CAST(substr(dst, 2) AS BIGINT) % 7 AS site FROM (
      SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem UNION ALL SELECT 's' || l_suppkey, 'o' || l_orderkey FROM lineitem
      UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders)),
    n0 AS MATERIALIZED (SELECT DISTINCT 'p' || arg_min(p_partkey, p_retailprice * 1000000 + p_partkey) AS url,
      'k' || arg_min(p_partkey, p_retailprice * 1000000 + p_partkey) % 7 AS site FROM part GROUP BY p_brand)"""]
    for i in range(ROUNDS):
        used = " UNION ALL ".join(f"SELECT site FROM t{j} WHERE diambil" for j in range(i)) or "SELECT NULL AS site LIMIT 0"
        parts.append(f"""t{i} AS MATERIALIZED (SELECT url, n.site, {i} AS depth,
          row_number() OVER (PARTITION BY n.site ORDER BY url) + coalesce(u.n, 0) <= {BUDGET} AS diambil
          FROM n{i} n LEFT JOIN (SELECT site, count(*) AS n FROM ({used}) GROUP BY 1) u ON u.site = n.site)""")
        met = " UNION ALL ".join(f"SELECT url FROM t{j}" for j in range(i + 1))
        parts.append(f"""n{i + 1} AS MATERIALIZED (SELECT dst AS url, min(e.site) AS site FROM edges e JOIN t{i} t ON t.url = e.src AND t.diambil
          WHERE dst NOT IN ({met}) GROUP BY 1)""")
    return "WITH " + ",\n".join(parts) + " " + " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(ROUNDS))


@query("crawl_budget", _budget_sql())
def crawl_budget(spark, sf):
    """Parts link to suppliers, suppliers to orders, orders to customers; seven sites with forty pages each."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")

    def node(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    def site(c):
        return F.concat(F.lit("k"), (F.substring(c, 2, 20).cast("long") % 7).cast("string")).alias("site")

    edges = li.select(node("p", "l_partkey").alias("src"), node("s", "l_suppkey").alias("dst"))
    edges = edges.unionByName(li.select(node("s", "l_suppkey").alias("src"), node("o", "l_orderkey").alias("dst")))
    edges = edges.unionByName(o.select(node("o", "o_orderkey").alias("src"), node("c", "o_custkey").alias("dst")))
    first = F.min_by("p_partkey", F.col("p_retailprice") * 1000000 + F.col("p_partkey"))
    seeds = table(spark, sf, "part").groupBy("p_brand").agg(first.alias("k")).select(node("p", "k").alias("url"))
    return FR.crawl_within_budget(seeds.select("url", site("url")), edges.select("src", "dst", site("dst")), BUDGET, max_depth=ROUNDS - 1)


_MOVES = ", ".join(f"('{e}', '{a}', '{b}')" for e, a, b in J.MOVES)


@query(
    "job_transitions",
    f"""WITH RECURSIVE m(event, a, b) AS (VALUES {_MOVES}),
    e AS (SELECT CAST(user_id AS VARCHAR) AS job, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i,
      CASE event_type WHEN 'view' THEN 'create' WHEN 'click' THEN 'start' WHEN 'purchase' THEN CASE WHEN value < 5 THEN 'pause' ELSE 'request_pause' END
        WHEN 'signup' THEN CASE WHEN value < 15 THEN 'resume' ELSE 'finish' END ELSE CASE WHEN value < 20 THEN 'ping' ELSE 'fail' END END AS event FROM events),
    s AS (SELECT job, seq, i, e.event, '' AS sebelum, coalesce(m.b, '') AS sesudah, m.b IS NOT NULL AS sah FROM e LEFT JOIN m ON m.event = e.event AND m.a = '' WHERE i = 1
      UNION ALL SELECT s.job, e.seq, e.i, e.event, s.sesudah, coalesce(m.b, s.sesudah), m.b IS NOT NULL
      FROM s JOIN e ON e.job = s.job AND e.i = s.i + 1 LEFT JOIN m ON m.event = e.event AND m.a = s.sesudah)
    SELECT job, seq, event, sebelum, sesudah, sah FROM s""",
)
def job_transitions(spark, sf):
    """Users are jobs; every event asks for a move, legal or not."""
    kind, v = F.col("event_type"), F.col("value")
    event = (
        F.when(kind == "view", "create").when(kind == "click", "start")
        .when(kind == "purchase", F.when(v < 5, "pause").otherwise("request_pause"))
        .when(kind == "signup", F.when(v < 15, "resume").otherwise("finish"))
        .otherwise(F.when(v < 20, "ping").otherwise("fail")))
    e = table(spark, sf, "events").select(F.col("user_id").alias("job"), F.col("event_id").alias("seq"), event.alias("event"))
    return J.job_transitions(e, "job", "seq", "event")


_API_SQL = f"""p AS (SELECT page_id, url, {S.host('url')} AS host, {S.path('url')} AS path FROM pages),
    u AS (SELECT page_id, url, host, path, regexp_replace(string_split(rtrim(path, '/'), '/')[-1], '[.][A-Za-z0-9]{{1,5}}$', '') AS slug, {S.ext('path', '^/([a-z]+)/')} AS bahasa,
      {S.ext('path', '^/[a-z]+/([0-9]+)')} AS nomor, length(host) % 4 AS bentuk FROM p),
    r AS (SELECT *, CASE WHEN bentuk = 0 THEN 1 WHEN bentuk = 1 AND regexp_matches(url, '/(en|fr)/[0-9]+') THEN 1
        WHEN bentuk = 2 AND contains(path, '/de/') THEN 1 WHEN bentuk = 2 AND regexp_matches(url, '/fr/[0-9]+$') THEN 2 WHEN bentuk = 2 THEN 3 END AS rule_no FROM u),
    e AS (SELECT *, 'https://api.' || host || CASE WHEN bentuk = 1 THEN '/' || bahasa || '/' || nomor ELSE '/isi/' || slug END AS endpoint,
      (bentuk = 1) AS berjson FROM r WHERE rule_no IS NOT NULL)"""


@query(
    "rule_table",
    f"""WITH {_API_SQL} SELECT page_id, rule_no, endpoint FROM e""",
)
def rule_table(spark, sf):
    """Each host configures its services in another shape; the first rule of each page and the endpoint it names."""
    pages, rules, _ = _services(spark, sf)
    m = A.first_rules(pages, rules.withColumn("nomor", F.col("rule_no")), "page_id", "url").join(pages.select("page_id", "url"), "page_id")
    return m.select("page_id", F.col("rule.nomor").alias("rule_no"), A.fill_endpoint(F.col("rule.url"), "url", "groups").alias("endpoint"))


def _services(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", U.host("url").alias("site"))
    api = F.concat(F.lit("https://api."), "site")
    isi, kind = F.concat(api, F.lit("/isi/{slug}")), F.length("site") % 4
    config = (
        F.when(kind == 0, isi)
        .when(kind == 1, F.concat(F.lit('{"match": "/(en|fr)/([0-9]+)", "endpoint": "'), api, F.lit('/{1}/{2}", "field": "data.isi", "titleField": "data.judul", "format": "text", "min_length": "14"}')))
        .when(kind == 2, F.concat(
            F.lit('{"rules": [{"match": "/de/", "url": "'), isi, F.lit('"}, 7, {"match": "("}, {"url_pattern": "/fr/[0-9]+$", "url": "'), isi,
            F.lit('", "format": "text"}, {"url": "'), isi, F.lit('", "format": "text"}]}')))
        .otherwise(F.lit('{"enabled": false, "url": "https://mati.example/"}')))
    sites = pages.select("site").distinct().select("site", config.alias("config"))
    last = F.element_at(F.split(F.rtrim(U.path("url"), F.lit("/")), "/"), -1)
    slug = F.regexp_replace(last, "[.][A-Za-z0-9]{1,5}$", "")
    part = F.regexp_extract(U.path("url"), "^/([a-z]+)/", 1)
    number = F.regexp_extract(U.path("url"), "^/[a-z]+/([0-9]+)", 1)
    plain = pages.select(F.concat(api, F.lit("/isi/"), slug).alias("endpoint"), slug.alias("k"), F.concat(F.lit("Isi <b>"), slug, F.lit("</b> &amp; lain")).alias("body"))
    found = pages.select(
        F.concat(api, F.lit("/"), part, F.lit("/"), number).alias("endpoint"), number.alias("k"),
        F.concat(F.lit('{"data": {"isi": ["Teks <i>nomor</i>", '), number, F.lit('], "judul": "Judul  '), part, F.lit('"}}')).alias("body"))
    answers = plain.unionByName(found).dropDuplicates(["endpoint"])
    answers = answers.select("endpoint", F.when(F.try_to_number("k", F.lit("999999999")) % 5 == 0, 404).otherwise(200).alias("http"), "body")
    return pages, A.api_rules(sites, "site", "config"), answers


@query(
    "content_api",
    f"""WITH {_API_SQL},
    t AS (SELECT page_id, endpoint, berjson, try_cast(CASE WHEN berjson THEN nomor ELSE slug END AS BIGINT) % 5 = 0 AS hilang, bahasa,
      CASE WHEN berjson THEN 'Teks nomor' || chr(10) || chr(10) || nomor WHEN bentuk = 0 OR rule_no = 1 THEN 'Isi **' || slug || '** & lain' ELSE 'Isi ' || slug || ' & lain' END AS md FROM e),
    g AS (SELECT *, CASE WHEN hilang THEN 'HTTP 404' WHEN berjson AND length(md) < 14 THEN 'isi terlalu pendek (' || length(md) || ' < 14 karakter)' END AS galat FROM t)
    SELECT page_id, endpoint, CASE WHEN galat IS NULL THEN md END AS markdown, CASE WHEN galat IS NULL THEN CASE WHEN berjson THEN 'Judul ' || bahasa ELSE '' END END AS title,
      CASE WHEN berjson THEN 'data.isi' ELSE '<badan>' END AS field, galat FROM g""",
)
def content_api(spark, sf):
    """Page texts from the services their hosts configure: four shapes of rules, plain and JSON answers, some missing."""
    pages, rules, answers = _services(spark, sf)
    return A.content_pages(pages, rules, answers, "page_id", "url")


@query(
    "host_modes",
    f"""WITH h AS (SELECT page_id, {S.host('url')} AS host, array_to_string(string_split({S.host('url')}, '.')[-2:], '.') AS dom FROM pages),
    own AS (SELECT DISTINCT host, dom FROM h WHERE host LIKE 'm.%'),
    rest AS (SELECT host, dom, min(page_id) AS pertama FROM h WHERE host NOT IN (SELECT host FROM own) GROUP BY 1, 2),
    opened AS (SELECT 'all' AS mode, host FROM (SELECT * FROM rest ORDER BY pertama, host LIMIT 15)
      UNION ALL SELECT 'family', host FROM (SELECT * FROM rest WHERE dom IN (SELECT dom FROM own) ORDER BY pertama, host LIMIT 15)),
    m(mode) AS (VALUES ('off'), ('family'), ('all'))
    SELECT mode, page_id, h.host, h.host IN (SELECT host FROM own) OR (mode, h.host) IN (SELECT (mode, host) FROM opened) AS boleh FROM h, m""",
)
def host_modes(spark, sf):
    """Mobile hosts are where a crawl starts; what each mode opens besides them, fifteen hosts at most."""
    p = table(spark, sf, "pages").select("page_id", U.host("url").alias("host"))
    starts = p.filter(F.col("host").startswith("m.")).select("host")
    modes = [FR.admit_hosts(p, starts, "host", "page_id", m, 15).select(F.lit(m).alias("mode"), "page_id", "host", "boleh") for m in ("off", "family", "all")]
    return modes[0].unionByName(modes[1]).unionByName(modes[2])
