"""Queries over raw pages: text, titles, links, robots rules, markdown."""

from __future__ import annotations

from pyspark.sql import functions as F


from docloom import constants as K
from docloom.functions import html as H, urls as U
from docloom.functions.titles import looks_generic, looks_like_file_name, with_title
from docloom.operators import links as L
from docloom.operators.htmlmd import html_to_markdown
from docloom.plans import sqltext as S
from docloom.plans.registry import query
from docloom.plans.text_queries import sql_normalized
from docloom.session import table


def _sql_drop(x: str, tags: list[str]) -> str:
    for t in tags:
        x = S.rep(x, rf"(?is)<{t}[^>]*>.*?</{t}>", " ")
    return x


_VISIBLE = S.collapse(
    S.entities(
        S.rep(
            S.rep(
                _sql_drop("html", ["head", "script", "style", "noscript", "template", "svg"]),
                r"(?s)<!--.*?-->", " ",
            ),
            r"<[!/?a-zA-Z][^>]*>", "",
        )
    )
)
_TITLE = S.collapse(S.entities(S.rep(S.ext("html", r"(?is)<title[^>]*>(.*?)</title>"), "<[^>]*>", "")))


@query("visible_text", f"SELECT page_id, {_VISIBLE} AS teks FROM pages")
def visible_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.visible_text("html").alias("teks"))


@query("html_title", f"SELECT page_id, {_TITLE} AS judul FROM pages")
def html_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.html_title("html").alias("judul"))


_H1 = S.collapse(S.entities(S.rep(S.ext("html", r"(?is)<h1[^>]*>(.*?)</h1>"), "<[^>]*>", "")))


@query(
    "document_title",
    f"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN {_TITLE} ELSE {_H1} END AS judul FROM pages""",
)
def document_title(spark, sf):
    """Half of the pages lose their <title> first, so both branches are exercised."""
    cut = F.regexp_replace("html", "(?is)<title[^>]*>.*?</title>", "")
    h = F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(cut)
    p = table(spark, sf, "pages").select("page_id", h.alias("html"))
    return p.select("page_id", H.document_title("html").alias("judul"))


@query(
    "strip_non_content",
    f"""SELECT page_id, length({S.trim(S.rep(_sql_drop('html', ['script', 'style']), '(?s)<!--.*?-->', ' '))}) AS panjang
    FROM pages""",
)
def strip_non_content(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.length(H.strip_non_content("html")).alias("panjang")
    )


@query(
    "js_skeleton",
    f"""WITH v AS (SELECT page_id, html, {_VISIBLE} AS t FROM pages)
    SELECT page_id, length(t) AS teks, length(t) < 400 AND (page_id % 3 = 0
      OR length(t)::DOUBLE / (strlen(html) + CASE WHEN page_id % 3 = 1 THEN 20000 ELSE 0 END) < 0.03) AS kerangka FROM v""",
)
def js_skeleton(spark, sf):
    """Every third page carries a root marker, every third a long script, so all rules apply."""
    marker = F.when(F.col("page_id") % 3 == 0, F.lit('<div id="root">')).otherwise(F.lit(""))
    script = F.when(F.col("page_id") % 3 == 1, F.repeat(F.lit("x"), 20000 - 7))
    # the added bytes sit inside a comment: visible text stays the same
    tail = F.coalesce(F.concat(F.lit("<!--"), script, F.lit("-->")), F.lit(""))
    p = table(spark, sf, "pages").withColumn("html", F.concat("html", marker, tail))
    p = p.select("page_id", "html", H.visible_text("html").alias("t"))
    return p.select(
        "page_id", F.length("t").alias("teks"), H.looks_like_skeleton("html", "t", 400).alias("kerangka")
    )


_LINKS_SQL = f"""
hrefs AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href,
    generate_subscripts(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), 1) AS pos FROM pages),
absolute AS (
  SELECT page_id, pos, lower({S.ext('url', '^([A-Za-z]+):')}) || '://' || {S.host('url')} || replace({S.entities('href')}, ' ', '') AS a
  FROM hrefs WHERE href LIKE '/%'),
links AS (SELECT page_id, {sql_normalized('a')} AS link, min(pos) AS pos FROM absolute GROUP BY 1, 2)
"""


@query(
    "extract_links",
    f"""WITH {_LINKS_SQL} SELECT page_id, link,
      row_number() OVER (PARTITION BY page_id ORDER BY pos) AS urutan FROM links""",
)
def extract_links(spark, sf):
    return L.extract_links(table(spark, sf, "pages"), "page_id", "url", "html").select("page_id", "link", "urutan")


@query(
    "text_urls",
    """WITH d AS (SELECT page_id, list_distinct([url, 'https://x.example/' || page_id]) AS u FROM pages)
    SELECT page_id, unnest(u) AS tautan FROM d""",
)
def text_urls(spark, sf):
    text = F.concat(
        F.lit("[Unduh]("), "url", F.lit(") lihat "), "url", F.lit(". https://x.example/"),
        F.col("page_id").cast("string"), F.lit(",; <b>"),
    )
    return table(spark, sf, "pages").select("page_id", F.explode(L.text_urls(text)).alias("tautan"))


def robots_bodies(spark, sf):
    """One robots text per page, written from the page's own links."""
    hrefs = F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))
    a = F.get(hrefs, F.lit(0))
    b = F.get(hrefs, F.lit(1))
    body = F.concat(
        F.lit("# aturan\r\nUser-agent: *\r\nDisallow: "), F.substring(a, 1, 2), F.lit("\r\nAllow: "), a,
        F.lit("\r\nCrawl-delay: 2\r\nDisallow:\r\n"),
        F.when(
            F.col("page_id") % 2 == 0,
            F.concat(F.lit("\nUser-agent: Docloom/1.0\nDisallow: "), b, F.lit(" # khusus\nCrawl-delay: 0.5\n")),
        ).otherwise(F.lit("\nUser-agent: lain\nDisallow: /\n")),
    )
    return table(spark, sf, "pages").select("page_id", "url", "html", body.alias("robots"))


_RULES_SQL = """
h AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS l FROM pages),
rules AS (
  SELECT page_id, 1 AS rule_no, page_id % 2 = 0 AS own, false AS allow,
    CASE WHEN page_id % 2 = 0 THEN l[2] ELSE substr(l[1], 1, 2) END AS path FROM h
  UNION ALL SELECT page_id, 2, false, true, l[1] FROM h WHERE page_id % 2 = 1)
"""


@query(
    "robots_parse",
    f"""WITH {_RULES_SQL} SELECT page_id, rule_no, allow, path,
      CASE WHEN page_id % 2 = 0 THEN 0.5 ELSE 2.0 END::DOUBLE AS jeda,
      CASE WHEN page_id % 2 = 0 THEN 1000 ELSE 2000 END AS jeda_ms FROM rules WHERE path <> ''""",
)
def robots_parse(spark, sf):
    d = L.parse_robots(robots_bodies(spark, sf), "robots", "docloom/2.0 (+x)")
    d = d.select("page_id", "crawl_delay", F.explode("rules").alias("r"))
    return d.select(
        "page_id", "r.rule_no", "r.allow", "r.path", F.col("crawl_delay").alias("jeda"),
        L.effective_delay_ms("crawl_delay", F.lit(1000)).alias("jeda_ms"),
    )


@query(
    "robots_allow",
    f"""WITH {_LINKS_SQL}, {_RULES_SQL}, t AS (
      SELECT page_id, link, {S.path('link')} AS target FROM links),
    hit AS (SELECT t.page_id, link, allow, row_number() OVER (PARTITION BY t.page_id, link
        ORDER BY strlen(path) DESC, rule_no) AS rn
      FROM t JOIN rules r ON r.page_id = t.page_id AND path <> '' AND starts_with(target, path))
    SELECT t.page_id, t.link, coalesce(allow, true) AS boleh
    FROM t LEFT JOIN hit h ON h.page_id = t.page_id AND h.link = t.link AND rn = 1""",
)
def robots_allow(spark, sf):
    p = robots_bodies(spark, sf)
    links = L.extract_links(p, "page_id", "url", "html")
    rules = L.parse_robots(p.select("page_id", "robots"), "robots", "docloom/2.0")
    return L.check_robots(links, rules, "page_id").select("page_id", "link", F.col("allowed").alias("boleh"))


@query(
    "link_admission",
    f"""WITH {_LINKS_SQL}, a AS (SELECT page_id, link, pos FROM links WHERE NOT {S.match('lower(link)', '[.](pdf|png)$')})
    SELECT {S.host('link')} AS host, count(*) AS tautan, count(DISTINCT link) AS unik FROM a GROUP BY 1""",
)
def link_admission(spark, sf):
    d = L.extract_links(table(spark, sf, "pages"), "page_id", "url", "html", ["pdf", "png"])
    return d.groupBy(U.host("link").alias("host")).agg(
        F.count("*").alias("tautan"), F.countDistinct("link").alias("unik")
    )


def _flat(x: str) -> str:
    """Text of a piece of HTML as an element's text content."""
    return S.collapse(S.entities(S.rep(x, r"<[!/?a-zA-Z][^>]*>", "")))


# The template of the pages: a div, then an article of one heading and paragraphs, which may open a bold mark.
# Content root: the element with the least text of at least 60 % of the body's, if the body has 400 characters.
@query(
    "html_to_markdown",
    f"""WITH p AS (SELECT page_id, {_TITLE} AS title, {S.ext('html', '(?is)(<div class="ad">.*)</article>')} AS body,
      {S.ext('html', '(?is)<div class="ad">(.*?)</div>')} AS ad, {S.ext('html', '(?is)<article>(.*)</article>')} AS art FROM pages),
    q AS (SELECT *, list_concat([ad], regexp_split_to_array(art, '</?(?:p|h1)>')) AS parts, length({_flat('body')}) AS n, length({_flat('art')}) AS n_art FROM p),
    b AS (SELECT page_id, x, i, n, n_art, {S.collapse(S.entities(S.rep("x", r"<[!/?a-zA-Z][^>]*>", " ")))} AS t, length({_flat('x')}) AS k
      FROM (SELECT page_id, n, n_art, unnest(parts) AS x, generate_subscripts(parts, 1) AS i FROM q)),
    r AS (SELECT page_id, CASE WHEN any_value(n) < {K.ROOT_MIN_CHARS} THEN -1 ELSE coalesce(arg_min(i, k * 1000000 + i) FILTER (fits), 0) END AS i,
      min(k) FILTER (fits) AS k, any_value(n_art) AS n_art, any_value(n) AS n FROM (SELECT *, k >= floor(n * {K.ROOT_SHARE}::DOUBLE) AS fits FROM b) GROUP BY 1),
    root AS (SELECT page_id, CASE WHEN i < 0 THEN -1 WHEN n_art >= floor(n * {K.ROOT_SHARE}::DOUBLE) AND (i = 0 OR n_art <= k) THEN 0 WHEN i = 0 THEN -1 ELSE i END AS root FROM r),
    m AS (SELECT page_id, string_agg(CASE WHEN i = 3 AND root <> 3 THEN '# ' || t WHEN x LIKE '<b>%' THEN '**' || t || '**' ELSE t END, chr(10) || chr(10) ORDER BY i) AS markdown
      FROM b JOIN root USING (page_id) WHERE t <> '' AND (root = -1 OR (root = 0 AND i > 1) OR root = i) GROUP BY 1)
    SELECT page_id, title, coalesce(markdown, '') AS markdown FROM p LEFT JOIN m USING (page_id)""",
)
def html_to_markdown_query(spark, sf):
    return html_to_markdown(table(spark, sf, "pages"))


_ARTICLE = S.collapse(S.entities(S.rep(S.ext("html", r"(?is)<article>(.*)</article>"), r"<[!/?a-zA-Z][^>]*>", " ")))


@query(
    "markdown_words",
    f"""WITH v AS (SELECT page_id, {_VISIBLE} AS t, {_ARTICLE} AS a, {S.entities(S.ext('html', '(?is)<div class="ad">(.*?)</div>'))} AS ad FROM pages)
    SELECT page_id, sha1((array_to_string(list_filter(regexp_split_to_array(
      CASE WHEN length(ad) + length(a) > 0 THEN ad || ' ' || a ELSE a END, '[^\\p{{L}}]+'), lambda x: x <> ''), ' '))) AS kata FROM v""",
)
def markdown_words(spark, sf):
    """Words of the markdown of whole bodies, so that no root element is chosen."""
    body = F.regexp_extract("html", r"(?is)(<body.*)$", 1)
    # digits in many paragraphs keep every single element below the root share
    p = table(spark, sf, "pages").select("page_id", body.alias("html"))
    pad = F.repeat(F.lit("<p>" + "1 " * 100 + "</p>"), F.ceil(F.length("html") / 100).cast("int"))
    p = p.withColumn("html", F.replace("html", F.lit("<footer>"), F.concat(pad, F.lit("<footer>"))))
    md = html_to_markdown(p)
    words = F.filter(F.split("markdown", r"[^\p{L}]+"), lambda w: w != "")
    return md.select("page_id", F.sha1(F.array_join(words, " ")).alias("kata"))


_HOST = S.hostname("url")


@query(
    "site_title_first",
    f"""WITH t AS (SELECT page_id, {_HOST} AS situs, {_TITLE} AS judul FROM pages)
    SELECT situs, arg_min(judul, page_id) AS judul_situs, count(*) AS halaman FROM t WHERE judul <> '' GROUP BY 1""",
)
def site_title_first(spark, sf):
    p = table(spark, sf, "pages").select("page_id", U.hostname("url").alias("situs"), H.html_title("html").alias("judul"))
    return p.filter(F.col("judul") != "").groupBy("situs").agg(
        F.min_by("judul", "page_id").alias("judul_situs"), F.count("*").alias("halaman")
    )


def _titled_pages(spark, sf):
    """Pages whose titles are, in turn, a site name, a file name, a number and their own."""
    n = F.col("page_id") % 4
    title = (
        F.when(n == 0, F.concat(F.lit("Situs "), U.hostname("url")))
        .when(n == 1, F.lit("laporan-akhir.pdf"))
        .when(n == 2, F.lit("2024"))
        .otherwise(H.html_title("html"))
    )
    heading = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit("teks\n## Bagian *"), F.col("page_id").cast("string"), F.lit("* akhir\nisi"))
    )
    return table(spark, sf, "pages").select(
        "page_id", "url", U.hostname("url").alias("situs"),
        F.concat(F.lit("<html><title>"), title, F.lit("</title>")).alias("html"), heading.alias("md"),
    )


@query(
    "resolve_title",
    f"""WITH p AS (SELECT page_id, url, {_HOST} AS situs, CASE page_id % 4 WHEN 0 THEN 'Situs ' || ({_HOST})
        WHEN 1 THEN 'laporan-akhir.pdf' WHEN 2 THEN '2024' ELSE {_TITLE} END AS t,
        CASE WHEN page_id % 3 = 0 THEN '' ELSE 'Bagian ' || page_id || ' akhir' END AS h FROM pages),
    f AS (SELECT *, first_value(page_id) OVER w AS fp, first_value(t) OVER w AS ft FROM p
        WINDOW w AS (PARTITION BY situs ORDER BY CASE WHEN t = '' THEN 1 ELSE 0 END, page_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    g AS (SELECT *, CASE WHEN t = ft AND page_id <> fp AND h <> '' THEN '' ELSE t END AS t2,
        {S.trim("translate(" + S.path('url') + ", '-_/', '   ')")} AS lbl FROM f)
    SELECT page_id, CASE WHEN t2 <> '' AND page_id % 4 NOT IN (1, 2) AND NOT {S.match('lower(t2)', '^[a-z0-9]+(-[a-z0-9]+){2,}$')} THEN t2
      WHEN h <> '' THEN h WHEN lbl = '' THEN {S.hostname('url')}
      ELSE array_to_string(list_transform(string_split(lbl, ' '), lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' ') END AS judul
    FROM g""",
)
def resolve_title(spark, sf):
    p = with_title(_titled_pages(spark, sf), "situs", "page_id", "url", "html", "md")
    return p.select("page_id", "judul")


@query(
    "title_flags",
    f"""WITH t AS (SELECT doc_id, trim(string_split(text, chr(10))[1]) AS baris, CASE doc_id % 4 WHEN 0 THEN source || '-a-' || doc_id
        WHEN 1 THEN 'lampiran.docx' WHEN 2 THEN 'Dokumen' ELSE doc_id::VARCHAR END AS judul FROM documents)
    SELECT doc_id, doc_id % 4 IN (0, 1) AS nama_berkas, doc_id % 4 IN (2, 3) AS umum FROM t""",
)
def title_flags(spark, sf):
    n = F.col("doc_id") % 4
    d = F.col("doc_id").cast("string")
    title = (
        F.when(n == 0, F.concat("source", F.lit("-a-"), d))
        .when(n == 1, F.lit("lampiran.docx"))
        .when(n == 2, F.lit("Dokumen"))
        .otherwise(d)
    )
    return table(spark, sf, "documents").select("doc_id", title.alias("t")).select(
        "doc_id", looks_like_file_name("t").alias("nama_berkas"), looks_generic("t").alias("umum")
    )


@query(
    "response_kind",
    f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'html' WHEN 1 THEN 'dokumen' WHEN 2 THEN 'dokumen' ELSE 'tolak' END AS jenis,
      CASE page_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'pdf' WHEN 2 THEN 'xlsx' END AS ekstensi FROM pages""",
)
def response_kind(spark, sf):
    """Each page answers as HTML, as a PDF body, with a file-name header, or as an image."""
    n = F.col("page_id") % 4
    ct = F.when(n == 0, F.lit(None).cast("string")).when(n == 3, F.lit("image/png")).otherwise(
        F.lit("application/octet-stream")
    )
    body = F.when(n == 1, F.concat(F.lit("%PDF-1.7 "), "html")).otherwise(F.col("html"))
    header = F.when(n == 2, F.concat(F.lit("attachment; filename*=UTF-8''Data%20"), F.col("page_id").cast("string"), F.lit(".XLSX")))
    p = table(spark, sf, "pages").select("page_id", ct.alias("ct"), body.cast("binary").alias("body"), header.alias("h"))
    is_html = H.looks_like_html("ct", F.decode(F.substring("body", 1, 1024), "ISO-8859-1"))
    e = F.coalesce(
        U.extension_for_content_type("ct"), H.extension_from_disposition("h"), H.extension_from_content("body")
    )
    return p.select(
        "page_id",
        F.when(is_html, F.lit("html")).when(e.isNotNull(), F.lit("dokumen")).otherwise(F.lit("tolak")).alias("jenis"),
        F.when(~is_html, e).alias("ekstensi"),
    )


