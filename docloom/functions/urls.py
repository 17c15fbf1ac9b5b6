"""URL parsing, normalisation and classification as Column expressions.

``parse_url`` is avoided on purpose: it rejects paths with spaces, which pages
really contain.  Every part is taken with one anchored pattern instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import ids
from docloom.functions.text import col, decode_entities, let, one_line, slug, trim

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url, n: int) -> Column:
    return F.regexp_extract(col(url), _URL, n)


def scheme(url) -> Column:
    return F.lower(_part(url, 1))


def authority(url) -> Column:
    return F.regexp_replace(_part(url, 2), "^[^@]*@", "")


def host(url) -> Column:
    return F.lower(F.regexp_replace(authority(url), ":[0-9]*$", ""))


def port(url) -> Column:
    return F.regexp_extract(authority(url), ":([0-9]+)$", 1)


def path(url) -> Column:
    return _part(url, 3)


def query(url) -> Column:
    return _part(url, 4)


def hostname(url) -> Column:
    """Lower-case host, or the input itself when it has none."""
    h = host(url)
    return F.when(h != "", h).otherwise(col(url))


def extension(url) -> Column:
    """Lower-case extension of the last path segment ('' when there is none)."""
    return F.lower(F.regexp_extract(path(url), r"\.([^./]*)$", 1))


def is_document_url(url) -> Column:
    return extension(url).isin(K.DOCUMENT_EXTENSIONS)


def looks_like_download(url) -> Column:
    words = "|".join(w.replace("-", r"\-") for w in K.DOWNLOAD_KEYWORDS)
    return F.lower(F.concat(path(url), F.lit("?"), query(url))).rlike(words)


def is_document_link(url) -> Column:
    return is_document_url(url) | looks_like_download(url)


def extension_for(url) -> Column:
    e = extension(url)
    return F.when(e.isin(K.DOCUMENT_EXTENSIONS), e).otherwise(F.lit("html"))


def extension_for_content_type(content_type) -> Column:
    mime = F.lower(trim(F.split(col(content_type), ";", 2)[0]))
    table = F.create_map(*[F.lit(x) for kv in K.DOCUMENT_MIME_EXTENSIONS.items() for x in kv])
    return table[mime]


def upload_mime(file_name) -> Column:
    table = F.create_map(*[F.lit(x) for kv in K.UPLOAD_MIME.items() for x in kv])
    e = F.lower(F.regexp_extract(col(file_name), r"\.([^./]*)$", 1))
    return F.coalesce(table[e], F.lit(K.DEFAULT_UPLOAD_MIME))


def has_skipped_extension(url, skip: list[str]) -> Column:
    return extension(url).isin(skip)


def skip_extensions(follow_documents: bool) -> list[str]:
    if not follow_documents:
        return list(K.SKIP_LINK_EXTENSIONS)
    return [e for e in K.SKIP_LINK_EXTENSIONS if e not in K.DOCUMENT_EXTENSIONS]


def _rfc3986(c: Column) -> Column:
    e = F.url_encode(c)
    e = F.replace(F.replace(e, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return F.replace(e, F.lit("%7E"), F.lit("~"))


def _url_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def clean_query(q) -> Column:
    """Query without trackers, last value per key, keys sorted, RFC 3986 encoded."""
    pairs = F.filter(F.split(col(q), "&"), lambda p: (p != "") & ~p.startswith("="))
    pairs = F.transform(
        pairs,
        lambda p: F.struct(
            F.regexp_replace(_url_decode(F.regexp_extract(p, "^([^=]*)", 1)), "[ .]", "_").alias(
                "k"
            ),
            _url_decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    rendered = let(pairs, _rendered_pairs)
    return F.when(col(q) == "", F.lit("")).otherwise(
        F.concat(F.when(rendered != "", F.lit("?")).otherwise(F.lit("")), rendered)
    )


def _rendered_pairs(pairs: Column) -> Column:
    keys = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["k"])))
    keys = F.filter(keys, lambda k: ~k.isin(K.TRACKING_PARAMS))
    return F.array_join(
        F.transform(
            keys,
            lambda k: F.concat(
                _rfc3986(k),
                F.lit("="),
                _rfc3986(F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]),
            ),
        ),
        "&",
    )


def absolutize(href, base) -> Column:
    h, b = col(href), col(base)
    base_scheme = F.when(scheme(b) != "", scheme(b)).otherwise(F.lit("https"))
    base_port = port(b)
    origin = F.concat(
        base_scheme,
        F.lit("://"),
        F.regexp_replace(authority(b), ":[0-9]*$", ""),
        F.when(base_port != "", F.concat(F.lit(":"), base_port)).otherwise(F.lit("")),
    )
    base_path = F.when(path(b) != "", path(b)).otherwise(F.lit("/"))
    directory = F.regexp_extract(base_path, "^(.*/)", 1)
    directory = F.when(directory == "", F.lit("/")).otherwise(directory)
    return (
        F.when(h.rlike("(?i)^https?://"), h)
        .when(h.startswith("//"), F.concat(base_scheme, F.lit(":"), h))
        .when(host(b) == "", F.lit(None))
        .when(h.startswith("?"), F.concat(origin, base_path, h))
        .when(h.startswith("/"), F.concat(origin, h))
        .otherwise(F.concat(origin, directory, h))
    )


def _clean_href(href) -> Column:
    return F.regexp_replace(decode_entities(trim(href)), "[\n\r\t ]", "")


def _usable_href(h: Column) -> Column:
    return (h != "") & ~h.startswith("#") & ~h.rlike(f"(?i)^({K.NON_PAGE_SCHEMES}):")


def _rebuild(a: Column) -> Column:
    keep_port = ~port(a).isin("", "80", "443")
    p = F.when(path(a) != "", path(a)).otherwise(F.lit("/"))
    p = F.regexp_replace(F.regexp_replace(p, r"/\./", "/"), "/{2,}", "/")
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    url = F.concat(
        scheme(a),
        F.lit("://"),
        host(a),
        F.when(keep_port, F.concat(F.lit(":"), port(a))).otherwise(F.lit("")),
        p,
        clean_query(query(a)),
    )
    return F.when((host(a) != "") & scheme(a).isin("http", "https"), url)


def normalize_url(href, base) -> Column:
    """Clean absolute URL, NULL for fragments, other schemes and broken input.

    Each step is bound to a lambda variable, so it is evaluated once per row even when the
    optimizer copies the expression into a pushed-down filter.
    """
    return let(
        _clean_href(href),
        lambda h: let(F.when(_usable_href(h), absolutize(h, base)), _rebuild),
    )


def with_normalized_url(df: DataFrame, href, base, out: str) -> DataFrame:
    return df.withColumn(out, normalize_url(href, base))


def normalize_host(value) -> Column:
    v = F.lower(trim(value))
    return F.when(v.contains("://"), host(v)).otherwise(v)


def registrable_domain(value) -> Column:
    """Last two labels, or three under a two-level public suffix."""
    labels = F.filter(F.split(normalize_host(value), r"\."), lambda x: x != "")
    n = F.size(labels)
    keep = F.when(
        n <= 2, n
    ).otherwise(F.when(F.get(labels, n - 2).isin(K.TWO_LEVEL_SUFFIXES), 3).otherwise(2))
    return F.array_join(F.slice(labels, F.greatest(n - keep, F.lit(0)) + 1, keep), ".")


def same_family(a, b) -> Column:
    return (registrable_domain(a) != "") & (registrable_domain(a) == registrable_domain(b))


def discovery_domain(value) -> Column:
    v = trim(value)
    v = F.when(v.contains("://"), v).otherwise(F.concat(F.lit("https://"), v))
    return F.regexp_replace(host(v), r"^www\.", "")


def origin(url) -> Column:
    p = port(url)
    o = F.concat(
        scheme(url),
        F.lit("://"),
        F.regexp_replace(authority(url), ":[0-9]*$", ""),
        F.when(p != "", F.concat(F.lit(":"), p)).otherwise(F.lit("")),
    )
    return F.when((scheme(url) != "") & (host(url) != ""), o).otherwise(F.lit(""))


def url_key(url) -> Column:
    return F.regexp_replace(F.lower(trim(F.split(col(url), "#", 2)[0])), "/+$", "")


def label_from_url(url) -> Column:
    p = F.btrim(path(url), F.lit("/"))
    last = F.element_at(F.split(p, "/"), -1)
    return F.when(p == "", F.concat(hostname(url), F.lit("-beranda"))).otherwise(last)


def document_file_name(url, ext=None) -> Column:
    """``<slug>--<hash8>.<ext>``: the stored name of one document."""
    e = extension_for(url) if ext is None else (F.lit(ext) if isinstance(ext, str) else ext)
    return F.concat(slug(label_from_url(url), 80), F.lit("--"), ids.hash8(url), F.lit("."), e)


def hash8_from_file_name(name) -> Column:
    return F.regexp_extract(col(name), r"--([0-9a-f]{8})\.[A-Za-z0-9]{1,6}$", 1)


def title_from_url(url) -> Column:
    """Path words with each first letter raised, the rest left as it is."""
    label = trim(F.translate(path(url), "-_/", "   "))
    words = F.transform(
        F.split(label, " "),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20)),
    )
    return F.when(label == "", hostname(url)).otherwise(F.array_join(words, " "))


def title_from_file_name(url) -> Column:
    name = F.regexp_replace(F.regexp_extract(path(url), "([^/]*)$", 1), r"\.[^.]*$", "")
    return one_line(F.translate(_url_decode(name), "-_", "  "), 240)


def site_id(url, with_path: bool = False) -> Column:
    base = slug(hostname(url), 60)
    if not with_path:
        return base
    p = F.btrim(path(url), F.lit("/"))
    last = F.element_at(F.split(p, "/"), -1)
    return F.when(p == "", base).otherwise(slug(F.concat(base, F.lit("-"), last), 60))


def allows_url(url, start_hosts, include: list[str], exclude: list[str], same_host: bool) -> Column:
    """Admission: http(s), own host, no exclude pattern, and any include pattern if given."""
    u = col(url)
    ok = u.rlike("(?i)^https?://")
    if same_host:
        ok = ok & F.array_contains(col(start_hosts), hostname(u))
    for pattern in exclude:
        ok = ok & ~u.rlike(f"(?i){pattern}")
    if include:
        any_include = F.lit(False)
        for pattern in include:
            any_include = any_include | u.rlike(f"(?i){pattern}")
        ok = ok & any_include
    return ok


# --- shared drive links -------------------------------------------------------


def drive_target(url) -> Column:
    """struct(tipe, id, format) of a shared drive or docs link; NULL for other URLs."""
    u = trim(url)
    h, p = host(u), path(u)
    doc_kind = F.regexp_extract(
        p, r"^/(document|spreadsheets|presentation)/d/([A-Za-z0-9_\-]{10,})", 1
    )
    doc_id = F.regexp_extract(
        p, r"^/(document|spreadsheets|presentation)/d/([A-Za-z0-9_\-]{10,})", 2
    )
    fmt = (
        F.when(doc_kind == "document", F.lit("docx"))
        .when(doc_kind == "spreadsheets", F.lit("xlsx"))
        .otherwise(F.lit("pptx"))
    )
    folder = F.regexp_extract(p, r"/(?:drive/)?(?:u/[0-9]+/)?folders/([A-Za-z0-9_\-]{10,})", 1)
    file = F.regexp_extract(p, r"/file/d/([A-Za-z0-9_\-]{10,})", 1)
    qid = _url_decode(F.regexp_extract(query(u), r"(?:^|&)id=([^&]*)", 1))
    q_folder = p.contains("embeddedfolderview") | p.contains("folders")
    q_ok = (qid != "") & p.rlike("^/?$|embeddedfolderview|/drive|/uc|/open")

    def target(kind, ident, form):
        return F.struct(
            F.lit(kind).alias("tipe") if isinstance(kind, str) else kind.alias("tipe"),
            ident.alias("id"),
            (F.lit(form) if isinstance(form, str) else form).alias("format"),
        )

    drive = h.isin("drive.google.com", "drive.usercontent.google.com")
    return (
        F.when((h == "docs.google.com") & (doc_kind != ""), target("native", doc_id, fmt))
        .when(drive & (folder != ""), target("folder", folder, "folder"))
        .when(drive & (file != ""), target("file", file, ""))
        .when(
            drive & q_ok,
            target(
                F.when(q_folder, F.lit("folder")).otherwise(F.lit("file")),
                qid,
                F.when(q_folder, F.lit("folder")).otherwise(F.lit("")),
            ),
        )
    )


def drive_download_url(target) -> Column:
    t = col(target)
    kind = (
        F.when(t["format"] == "docx", F.lit("document"))
        .when(t["format"] == "xlsx", F.lit("spreadsheets"))
        .otherwise(F.lit("presentation"))
    )
    export = F.concat(
        F.lit("https://docs.google.com/"), kind, F.lit("/d/"), t["id"],
        F.lit("/export?format="), t["format"],
    )
    direct = F.concat(
        F.lit("https://drive.usercontent.google.com/download?id="),
        _rfc3986(t["id"]),
        F.lit("&export=download&confirm=t"),
    )
    return F.when(t["format"].isin("docx", "xlsx", "pptx"), export).when(
        t["tipe"] == "file", direct
    )
