"""HTML text, titles and skeleton detection as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.text import collapse, col, decode_entities, trim

TAG = r"(?s)<[!/?a-zA-Z][^>]*>"
COMMENT = r"(?s)<!--.*?-->"


def strip_tags(c) -> Column:
    return F.regexp_replace(col(c), TAG, "")


def attribute(tag_text, name: str) -> Column:
    """Value of one attribute of a start tag, '' when it is absent."""
    head = rf"(?is)^<[a-z][^>]*?[\s\"'/]{name}\s*=\s*"
    found = F.regexp_extract(col(tag_text), head + r"""("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.regexp_replace(found, "^[\"']|[\"']$", "")


def visible_text(html) -> Column:
    t = F.regexp_replace(
        col(html), r"(?is)<(script|style|noscript|template|svg|head)[^>]*>.*?</\1>", " "
    )
    t = strip_tags(F.regexp_replace(t, COMMENT, " "))
    return collapse(decode_entities(t))


def strip_non_content(html) -> Column:
    tags = "script|style|noscript|template|svg|link|iframe"
    t = F.regexp_replace(col(html), rf"(?is)<({tags})\b[^>]*>.*?</\1\s*>", " ")
    t = F.regexp_replace(t, rf"(?is)<({tags})\b[^>]*/?>", " ")
    return trim(F.regexp_replace(t, COMMENT, " "))


def html_title(html) -> Column:
    inner = F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return collapse(decode_entities(strip_tags(inner)))


def _first_filled(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v != ""), F.lit(0))


def document_title(html) -> Column:
    """<title>, else the first non-empty <h1>, else a title meta tag, else ''."""
    h1 = F.regexp_extract_all(col(html), F.lit(r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"), F.lit(1))
    h1 = F.transform(h1, lambda v: collapse(decode_entities(strip_tags(v))))
    meta = F.regexp_extract_all(col(html), F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))
    meta = F.filter(
        meta,
        lambda m: F.lower(attribute(m, "property")).isin("og:title", "twitter:title")
        | (F.lower(attribute(m, "name")) == "title"),
    )
    meta = F.transform(meta, lambda m: collapse(decode_entities(attribute(m, "content"))))
    return F.coalesce(
        F.nullif(html_title(html), F.lit("")), _first_filled(h1), _first_filled(meta), F.lit("")
    )


def looks_like_skeleton(
    html, text, min_text: int = K.SKELETON_MIN_TEXT, max_ratio: float = K.SKELETON_MAX_RATIO
) -> Column:
    """Page whose content only appears after scripts run; ``text`` is its visible text.

    The ratio divides characters of text by bytes of HTML.
    """
    h, t = col(html), col(text)
    marked = h.rlike("(?iu)" + K.SCRIPT_MESSAGE)
    for m in K.SKELETON_MARKERS:
        marked = marked | h.contains(m)
    thin = F.length(t) / F.greatest(F.octet_length(h), F.lit(1)) < max_ratio
    return (h != "") & (F.length(t) < min_text) & (marked | thin)


def looks_like_html(content_type, head) -> Column:
    ct = F.lower(col(content_type))
    kinds = "text/html|application/xhtml|text/plain|text/xml|application/xml"
    by_head = F.lower(col(head)).rlike("<html|<!doctype")
    return F.when(F.coalesce(ct, F.lit("")) == "", by_head).otherwise(ct.rlike(kinds))


def extension_from_disposition(header) -> Column:
    names = F.regexp_extract_all(
        col(header), F.lit(r"(?i)\bfilename\*?\s*=\s*(?:UTF-8'')?([^;]+)"), F.lit(1)
    )
    ext = F.transform(
        names,
        lambda n: F.regexp_extract(
            F.lower(F.coalesce(F.try_url_decode(F.btrim(n, F.lit(" \t\"'"))), n)),
            r"\.([^./]*)$",
            1,
        ),
    )
    return F.get(F.filter(ext, lambda e: e.isin(K.DOCUMENT_EXTENSIONS)), F.lit(0))


def extension_from_content(body) -> Column:
    """Document kind from the leading bytes of a binary body."""
    head = F.decode(F.substring(col(body), 1, 8192), "ISO-8859-1")
    office = (
        F.when(head.contains("word/"), F.lit("docx"))
        .when(head.contains("xl/"), F.lit("xlsx"))
        .when(head.contains("ppt/"), F.lit("pptx"))
    )
    ole = (
        F.when(head.contains("WordDocument"), F.lit("doc"))
        .when(head.contains("Workbook"), F.lit("xls"))
        .when(head.contains("PowerPoint"), F.lit("ppt"))
    )
    return (
        F.when(head.startswith("%PDF-"), F.lit("pdf"))
        .when(head.startswith("PK"), office)
        .when(F.hex(F.substring(col(body), 1, 4)) == "D0CF11E0", ole)
        .when(F.ltrim(F.translate(head, "\t\r\n", "   ")).startswith("{\\rtf"), F.lit("rtf"))
    )


def looks_like_scanned_pdf(body) -> Column:
    head = F.decode(F.substring(col(body), 1, 300000), "ISO-8859-1")
    return ~head.contains("/Font") & (head.contains("/Image") | head.contains("/DCTDecode"))


def meta_charset(html) -> Column:
    return F.nullif(
        F.regexp_extract(
            F.substring(col(html), 1, 4096),
            r"""(?i)<meta[^>]+charset\s*=\s*["']?\s*([a-z0-9_\-]+)""",
            1,
        ),
        F.lit(""),
    )
