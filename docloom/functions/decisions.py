"""Yes-or-no rules about responses, parse results, jobs and file names, and bytes to text."""

from __future__ import annotations

import codecs
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import urls as U
from docloom.functions.text import col, trim


def is_document_response(status, content_type, url) -> Column:
    """A 2xx or 3xx answer of a document type, or without a type from a document address."""
    s, ct = col(status), col(content_type)
    typed = U.extension_for_content_type(ct).isNotNull()
    return (s >= 200) & (s < 400) & (typed | (ct.isNull() & U.is_document_url(url)))


def parse_accepted(ok, markdown, is_html, minimum: int = 50) -> Column:
    """A parse result counts if it has text; for pages it must reach the minimum length."""
    md = F.coalesce(col(markdown), F.lit(""))
    return col(ok) & (trim(md) != "") & (~col(is_html) | (F.length(md) >= max(1, minimum)))


def extension_allowed(url, extensions: list[str]) -> Column:
    """The address has one of the wished extensions; without wishes any document address will do."""
    wanted = [e.strip().lower() for e in extensions if e.strip()]
    return U.extension_for(url).isin(wanted) if wanted else U.is_document_link(url)


def is_active_job(status) -> Column:
    return F.upper(col(status)).isin(K.ACTIVE_JOB_STATUSES)


def pair_name(file_name) -> Column:
    """Name of the markdown file that belongs to a stored page; other names stay."""
    base = F.element_at(F.split(col(file_name), r"[/\\]"), -1)
    return F.regexp_replace(base, r"(?i)\.html?$", ".md")


_META = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?\s*([a-z0-9_\-]+)""", re.I)
_META_NAME = re.compile(r"""<meta([^>]*?)charset\s*=\s*["']?[a-z0-9_\-]+["']?""", re.I)
_BOM = b"\xef\xbb\xbf"


def _decoded(raw: bytes, declared: str | None) -> str:
    """Text of a body: byte order mark, declared charset, meta tag, else valid UTF-8 or Latin-1."""
    body = raw.removeprefix(_BOM)
    charset = declared or ""
    if not charset:
        m = _META.search(body[:4096])
        charset = m.group(1).decode("ascii") if m else ""
    if not charset:
        try:
            body.decode("utf-8")
            charset = "utf-8"
        except UnicodeDecodeError:
            charset = "iso-8859-1"
    try:
        codec = codecs.lookup(charset).name
    except LookupError:
        codec = "utf-8"
    text = body.decode(codec, "replace")
    if len(body) == len(raw) and codec == "utf-8":
        return text
    # what was converted names its new charset, once
    return _META_NAME.sub(r'<meta\1charset="UTF-8"', text, count=1)


def decode_body(body, declared) -> Column:
    """Text of a binary body; ``declared`` is the charset of the header, or null."""

    @F.pandas_udf("string")
    def run(bodies: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else _decoded(bytes(b), n) for b, n in zip(bodies, names)], dtype=object)

    return run(col(body), col(declared).cast("string"))
