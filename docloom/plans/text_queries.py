"""Identity, text and URL queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids, text as T, urls as U
from docloom.plans import sqltext as S
from docloom.plans.registry import query
from docloom.session import table


@query(
    "uuid5_document_id",
    f"""SELECT page_id, {S.uuid5('url')} AS document_id,
    ({S.slug(S.label('url'), 80)}) || '--' || substr({S.uuid5('url')}, 1, 8) || '.'
      || CASE WHEN {S.in_list(S.extension('url'), K.DOCUMENT_EXTENSIONS)} THEN {S.extension('url')}
         ELSE 'html' END AS berkas FROM pages""",
)
def uuid5_document_id(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", ids.document_id("url").alias("document_id"), U.document_file_name("url").alias("berkas")
    )


@query(
    "point_id",
    f"""SELECT doc_id, bentuk, CASE bentuk WHEN 'uuid' THEN {S.uuid5(S.DOC_URL)}
      WHEN 'angka' THEN doc_id::VARCHAR
      WHEN 'tanpa' THEN {S.uuid5("'chunk:' || doc_id || ':' || n_chars")}
      ELSE {S.uuid5("'chunk:' || doc_id || ':0'")} END AS point_id, bentuk = 'angka' AS bilangan
    FROM documents, (VALUES ('uuid'), ('angka'), ('gabungan'), ('tanpa')) v(bentuk)""",
)
def point_id(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", "n_chars",
        F.concat(
            F.lit("https://"), "source", F.lit(".example.com/dokumen/"), F.col("doc_id").cast("string")
        ).alias("url"),
        F.explode(F.split(F.lit("uuid angka gabungan tanpa"), " ")).alias("bentuk"),
    )
    doc = F.col("doc_id").cast("string")
    chunk = (
        F.when(F.col("bentuk") == "uuid", F.upper(ids.document_id("url")))
        .when(F.col("bentuk") == "angka", doc)
        .when(F.col("bentuk") == "gabungan", F.concat(doc, F.lit(":0")))
    )
    d = d.withColumn("chunk", chunk).withColumn("no", F.when(F.col("bentuk") != "tanpa", 0))
    p = ids.point_id("chunk", "doc_id", "no", "n_chars")
    return d.select("doc_id", "bentuk", p.alias("point_id"), ids.point_id_is_int(p).alias("bilangan"))


@query(
    "slugify",
    f"""SELECT page_id, {S.slug('url', 60)} AS slug, {S.slug(S.label('url'), 80)} AS label,
      {S.slug(S.hostname('url'), 60)} AS site_id,
      CASE WHEN trim({S.path('url')}, '/') = '' THEN {S.slug(S.hostname('url'), 60)}
        ELSE {S.slug('(' + S.slug(S.hostname('url'), 60) + ") || '-' || list_extract(string_split(trim(" + S.path('url') + ", '/'), '/'), -1)", 60)}
        END AS site_id_path FROM pages""",
)
def slugify(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", T.slug("url").alias("slug"), T.slug(U.label_from_url("url"), 80).alias("label"),
        U.site_id("url").alias("site_id"), U.site_id("url", with_path=True).alias("site_id_path"),
    )


@query(
    "normalize_ws",
    f"""WITH d AS (SELECT doc_id, {S.norm_ws('text')} AS t FROM documents)
    SELECT doc_id, length(t) AS panjang, sha256(t) AS sha256, sha1(t) AS sha1 FROM d""",
)
def normalize_ws(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.normalize_whitespace("text").alias("t"))
    return d.select(
        "doc_id", F.length("t").alias("panjang"), ids.content_sha256("t").alias("sha256"),
        ids.content_sha1("t").alias("sha1"),
    )


@query("one_line", f"SELECT doc_id, {S.one_line('text')} AS ringkas FROM documents")
def one_line(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.one_line("text").alias("ringkas"))


@query(
    "human_bytes",
    """WITH p AS (SELECT page_id, strlen(html) AS n FROM pages)
    SELECT page_id, CASE WHEN n < 1024 THEN n || 'B'
      WHEN n < 1048576 THEN round(n / 1024.0, 1)::DECIMAL(18,1) || 'KB'
      ELSE round(n / 1048576.0, 2)::DECIMAL(18,2) || 'MB' END AS ukuran FROM p""",
)
def human_bytes(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", T.human_bytes(F.octet_length("html")).alias("ukuran")
    )


@query(
    "durations",
    """SELECT event_id, round(value, 2)::DECIMAL(18,2) || 's' AS durasi,
      round(value * 60 / 60, 2)::DECIMAL(18,2) || ' menit' AS menit,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS waktu FROM events""",
)
def durations(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", T.duration("value").alias("durasi"),
        T.duration_minutes(F.col("value") * 60).alias("menit"), T.iso_utc("ts").alias("waktu"),
    )


@query(
    "word_counts",
    f"""SELECT doc_id, length(text) AS karakter, len(regexp_extract_all(text,
      '[A-Za-z{K.WORD_LETTERS}][A-Za-z{K.WORD_LETTERS}''\\-]*')) AS kata FROM documents""",
)
def word_counts(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.length("text").alias("karakter"), T.word_count("text").alias("kata")
    )


@query(
    "url_hostname",
    f"""SELECT page_id, {S.hostname('url')} AS host, {S.path('url')} AS path,
      {S.url_query('url')} AS kueri, {S.extension('url')} AS ekstensi,
      {S.rep(S.host('url'), '^www[.]', '', '')} AS domain,
      lower({S.ext('url', '^([a-z]+)://')}) || '://' || {S.host('url')} AS asal,
      {S.rep('lower(' + S.trim("string_split(url, '#')[1]") + ')', '/+$', '', '')} AS kunci
    FROM pages""",
)
def url_hostname(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", U.hostname("url").alias("host"), U.path("url").alias("path"),
        U.query("url").alias("kueri"), U.extension("url").alias("ekstensi"),
        U.discovery_domain("url").alias("domain"), U.origin("url").alias("asal"),
        U.url_key("url").alias("kunci"),
    )


def sql_normalized(u: str) -> str:
    """Clean form of an absolute page URL; queries are lists of plain key=value pairs."""
    p = f"CASE WHEN {S.path(u)} = '' THEN '/' ELSE {S.path(u)} END"
    p = S.rep(S.rep(f"({p})", r"/\./", "/"), "/{2,}", "/")
    p = f"CASE WHEN {p} = '/' THEN '/' ELSE {S.rep(p, '/+$', '')} END"
    drop = ", ".join(f"'{x}'" for x in K.TRACKING_PARAMS)
    q = (
        f"array_to_string(list_sort(list_filter(string_split({S.url_query(u)}, '&'), lambda x: x <> '' "
        f"AND string_split(x, '=')[1] NOT IN ({drop}))), '&')"
    )
    scheme = f"lower({S.ext(u, '^([A-Za-z]+):')})"
    return f"{scheme} || '://' || {S.host(u)} || ({p}) || CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END"


@query("url_normalize", f"SELECT page_id, {sql_normalized('url')} AS bersih FROM pages")
def url_normalize(spark, sf):
    p = U.with_normalized_url(table(spark, sf, "pages"), "url", "url", "bersih")
    return p.select("page_id", "bersih")


@query(
    "tracking_strip",
    f"""WITH q AS (SELECT page_id, 'b=2&utm_medium=x&' || {S.url_query('url')} || '&a=' || page_id
      || '&fbclid=1' AS q FROM pages)
    SELECT page_id, '?' || array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> ''
      AND {S.in_list("string_split(x, '=')[1]", K.TRACKING_PARAMS)} = false)), '&') AS kueri FROM q""",
)
def tracking_strip(spark, sf):
    q = F.concat(
        F.lit("b=2&utm_medium=x&"), U.query("url"), F.lit("&a="), F.col("page_id").cast("string"),
        F.lit("&fbclid=1"),
    )
    return table(spark, sf, "pages").select("page_id", U.clean_query(q).alias("kueri"))


@query(
    "registrable_domain",
    f"""WITH h AS (SELECT page_id, string_split({S.host('url')}, '.') AS p FROM pages)
    SELECT page_id, CASE WHEN len(p) <= 2 THEN array_to_string(p, '.')
      WHEN {S.in_list('p[-2]', K.TWO_LEVEL_SUFFIXES)} THEN array_to_string(p[-3:], '.')
      ELSE array_to_string(p[-2:], '.') END AS domain FROM h""",
)
def registrable_domain(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", U.registrable_domain(U.hostname("url")).alias("domain")
    )


@query(
    "url_admission",
    f"""WITH seed AS (SELECT {S.hostname('url')} AS h FROM pages WHERE page_id IN
        (SELECT min(page_id) FROM pages GROUP BY {S.ext('url', '/([a-z]{2})/')}))
    SELECT page_id, ({S.match('url', '(?i)^https?://')} AND {S.hostname('url')} IN (SELECT h FROM seed)
      AND NOT {S.match('url', '(?i)utm_source')}
      AND ({S.match('url', '(?i)/en/')} OR {S.match('url', '(?i)[.]html')})) AS boleh FROM pages""",
)
def url_admission(spark, sf):
    """Hosts of the first page of each language section are the start hosts."""
    p = table(spark, sf, "pages")
    seeds = p.groupBy(F.regexp_extract("url", "/([a-z]{2})/", 1)).agg(F.min_by("url", "page_id").alias("u"))
    hosts = seeds.select(U.hostname("u").alias("host")).distinct().withColumn("__seed", F.lit(True))
    d = p.withColumn("host", U.hostname("url")).join(hosts, "host", "left")
    own = F.when(F.col("__seed"), F.array("host")).otherwise(F.array().cast("array<string>"))
    ok = U.allows_url("url", own, ["/en/", r"\.html"], ["utm_source"], True)
    return d.select("page_id", ok.alias("boleh"))


_FILES = f"""links AS (SELECT page_id, {S.path('url')} AS p,
    'https://' || {S.host('url')} || {S.path('url')} || CASE page_id % 5 WHEN 0 THEN '/Laporan.PDF'
      WHEN 1 THEN '/unduh?id=' || page_id WHEN 2 THEN '/gambar.png' WHEN 3 THEN '/data.csv?x=1'
      ELSE '' END AS u FROM pages)"""


def _file_links(spark, sf):
    tail = (
        F.when(F.col("page_id") % 5 == 0, F.lit("/Laporan.PDF"))
        .when(F.col("page_id") % 5 == 1, F.concat(F.lit("/unduh?id="), F.col("page_id").cast("string")))
        .when(F.col("page_id") % 5 == 2, F.lit("/gambar.png"))
        .when(F.col("page_id") % 5 == 3, F.lit("/data.csv?x=1"))
        .otherwise(F.lit(""))
    )
    return table(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("https://"), U.host("url"), U.path("url"), tail).alias("u")
    )


@query(
    "document_url_flags",
    f"""WITH {_FILES}
    SELECT page_id, {S.in_list(S.extension('u'), K.DOCUMENT_EXTENSIONS)} AS dokumen,
      {S.match("lower(" + S.path('u') + " || '?' || " + S.url_query('u') + ")", 'download|unduh|berkas|lampiran|attachment|getfile|get-file')} AS unduhan,
      {S.in_list(S.extension('u'), K.SKIP_LINK_EXTENSIONS)} AS dilewati,
      {S.in_list(S.extension('u'), [e for e in K.SKIP_LINK_EXTENSIONS if e not in K.DOCUMENT_EXTENSIONS])} AS dilewati_dokumen,
      CASE WHEN {S.in_list(S.extension('u'), K.DOCUMENT_EXTENSIONS)} THEN {S.extension('u')} ELSE 'html' END AS simpan
    FROM links""",
)
def document_url_flags(spark, sf):
    return _file_links(spark, sf).select(
        "page_id", U.is_document_url("u").alias("dokumen"), U.looks_like_download("u").alias("unduhan"),
        U.has_skipped_extension("u", U.skip_extensions(False)).alias("dilewati"),
        U.has_skipped_extension("u", U.skip_extensions(True)).alias("dilewati_dokumen"),
        U.extension_for("u").alias("simpan"),
    )


@query(
    "content_types",
    f"""WITH {_FILES}, t AS (SELECT page_id, CASE {S.extension('u')} WHEN 'pdf' THEN 'Application/PDF; charset=binary'
        WHEN 'csv' THEN 'text/csv' WHEN 'png' THEN 'image/png' ELSE 'text/html; charset="UTF-8"' END AS ct,
        {S.extension('u')} AS e FROM links)
    SELECT page_id, CASE e WHEN 'pdf' THEN 'pdf' WHEN 'csv' THEN 'csv' END AS ekstensi,
      CASE e WHEN 'pdf' THEN 'binary' WHEN 'csv' THEN NULL WHEN 'png' THEN NULL ELSE 'UTF-8' END AS charset,
      CASE e WHEN 'pdf' THEN 'application/pdf' WHEN 'csv' THEN 'text/csv' ELSE 'text/html' END AS unggah
    FROM t""",
)
def content_types(spark, sf):
    e = U.extension("u")
    ct = (
        F.when(e == "pdf", F.lit("Application/PDF; charset=binary"))
        .when(e == "csv", F.lit("text/csv"))
        .when(e == "png", F.lit("image/png"))
        .otherwise(F.lit('text/html; charset="UTF-8"'))
    )
    d = _file_links(spark, sf).withColumn("ct", ct)
    return d.select(
        "page_id", U.extension_for_content_type("ct").alias("ekstensi"),
        T.charset_from_content_type("ct").alias("charset"), U.upload_mime(U.path("u")).alias("unggah"),
    )


@query(
    "drive_targets",
    """WITH d AS (SELECT page_id, md5(url) AS id, page_id % 5 AS b FROM pages)
    SELECT page_id, CASE b WHEN 0 THEN 'folder' WHEN 1 THEN 'file' WHEN 2 THEN 'native' WHEN 3 THEN 'file' END AS tipe,
      CASE WHEN b < 4 THEN id END AS id,
      CASE b WHEN 0 THEN 'folder' WHEN 1 THEN '' WHEN 2 THEN 'xlsx' WHEN 3 THEN '' END AS format,
      CASE b WHEN 1 THEN 'https://drive.usercontent.google.com/download?id=' || id || '&export=download&confirm=t'
        WHEN 2 THEN 'https://docs.google.com/spreadsheets/d/' || id || '/export?format=xlsx'
        WHEN 3 THEN 'https://drive.usercontent.google.com/download?id=' || id || '&export=download&confirm=t' END AS unduh
    FROM d""",
)
def drive_targets(spark, sf):
    """Each page stands for one shared link whose id is the hash of its URL."""
    i, b = F.md5("url"), F.col("page_id") % 5
    link = (
        F.when(b == 0, F.concat(F.lit("https://drive.google.com/drive/u/0/folders/"), i))
        .when(b == 1, F.concat(F.lit("https://drive.google.com/file/d/"), i, F.lit("/view")))
        .when(b == 2, F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), i, F.lit("/edit")))
        .when(b == 3, F.concat(F.lit("https://drive.google.com/open?id="), i))
        .otherwise(F.col("url"))
    )
    d = table(spark, sf, "pages").withColumn("__t", U.drive_target(link))
    return d.select(
        "page_id", "__t.tipe", "__t.id", "__t.format", U.drive_download_url("__t").alias("unduh")
    )


@query(
    "file_stats",
    f"""WITH {_FILES} SELECT CASE WHEN {S.in_list(S.extension('u'), K.DOCUMENT_EXTENSIONS)} THEN {S.extension('u')}
      ELSE 'html' END AS jenis, count(*) AS jumlah, sum(strlen(html))::BIGINT AS byte
    FROM links JOIN pages USING (page_id) GROUP BY 1""",
)
def file_stats(spark, sf):
    d = _file_links(spark, sf).join(
        table(spark, sf, "pages").select("page_id", F.octet_length("html").alias("n")), "page_id"
    )
    return d.groupBy(U.extension_for("u").alias("jenis")).agg(
        F.count("*").alias("jumlah"), F.sum("n").alias("byte")
    )
