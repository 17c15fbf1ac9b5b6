"""Choosing a readable document title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.html import html_title
from docloom.functions.markdown import first_heading
from docloom.functions.text import col, trim
from docloom.functions.urls import title_from_url


def looks_like_file_name(text, raw_file=None) -> Column:
    t = col(text)
    known = t.rlike(
        r"(?i)\.(html?|xhtml|pdf|docx?|xlsx?|pptx?|csv|rtf|txt|odt|ods|xml|json)$"
    )
    slugged = ~t.rlike(r"(?U)\s") & t.rlike(r"(?i)^[a-z0-9]+(?:-[a-z0-9]+){2,}$")
    result = known | slugged
    if raw_file is not None:
        base = F.regexp_extract(col(raw_file), r"([^/\\]*)$", 1)
        result = result | ((base != "") & (t == base))
    return result


def looks_generic(text) -> Column:
    t = F.lower(trim(text))
    return (t == "") | t.rlike(r"(?U)^\d+$") | t.isin(K.GENERIC_TITLES)


def acceptable(text, raw_file=None) -> Column:
    return F.when(
        (col(text) != "") & ~looks_like_file_name(text, raw_file) & ~looks_generic(text), col(text)
    )


def with_title(
    pages: DataFrame,
    site: str,
    seq: str,
    url: str,
    html: str,
    markdown: str,
    parse_title: str | None = None,
    preferred: str | None = None,
    raw_file: str | None = None,
    out: str = "judul",
    page_title: str | None = None,
    heading: str | None = None,
) -> DataFrame:
    """Add ``out``: given title, page title, heading, parser title, else words of the URL.

    A page title equal to the first page title of its site is the site's name; such pages use
    their heading when they have one.  The first title per site is a min_by aggregate, joined
    back on the site: small enough to broadcast at run time, or split by skew handling.
    Columns ``page_title`` and ``heading`` that are there already spare reading ``html`` and ``markdown``.
    """
    p = pages.withColumn("__t", F.col(page_title) if page_title else html_title(html))
    p = p.withColumn("__h", F.col(heading) if heading else first_heading(markdown))
    first = (
        p.filter(F.col("__t") != "")
        .groupBy(site)
        .agg(F.min_by(F.struct("__t", seq), seq).alias("__first"))
    )
    p = p.join(first, site, "left")
    is_site_title = (
        (F.col("__t") == F.col("__first.__t")) & (F.col(seq) != F.col(f"__first.{seq}")) & (F.col("__h") != "")
    )
    page_title = F.when(F.coalesce(is_site_title, F.lit(False)), F.lit("")).otherwise(F.col("__t"))
    blank = F.lit("")
    p = p.withColumn("__page", page_title)
    p = p.withColumn("__given", trim(col(preferred)) if preferred else blank)
    p = p.withColumn("__parse", trim(col(parse_title)) if parse_title else blank)
    picked = F.coalesce(
        *[acceptable(c, raw_file) for c in ["__given", "__page", "__h", "__parse"]], title_from_url(url)
    )
    return p.withColumn(out, picked).drop("__t", "__h", "__first", "__page", "__given", "__parse")
