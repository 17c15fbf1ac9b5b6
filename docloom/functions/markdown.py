"""Markdown line, label and window rules as Column expressions."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.arrays import last_before
from docloom.functions.text import col, collapse, let, replace_where, rtrim, trim

# fixed values: patterns of the cleaning rules (Java syntax, Unicode classes on)
LIST_MARK = r"(?U)^\s*(?:[-*+]|\d+[.)])\s+"
SEPARATOR = r"^[\-–—_=*.·•~^\\s]+$"
REPEATED_WORD = r"(?U)^([\p{L}\p{N}]+)(?:\s+\1\w*)+$"
FOOTER = r"(?U)(?:all rights reserved|Â©|©|\bver(?:si)?\.?\s*\d+(?:\.\d+)+)"
EMAIL = r"^[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}.\-]+\.[\p{L}]{2,}$"
STREET = r"(?U)^(?:jl\.?|jalan)\s+.{0,80}\bno\.?\s*\d+"
LIST_COUNTER = r"(?U)^menampilkan\s+\d+\s*[-–]\s*\d+\s+dari\s+total\s+\d+$"
PAGE_SIZE = r"(?U)^\d+\s*/\s*(?:page|halaman)$"
PAGE_NUMBER = r"(?U)^(?:[-*+]\s*)?\d{1,3}$"
IMAGE = r"!\[[^\]]*\]\([^)\n]*\)"
LINK_TARGET = r"\]\([^)\n]*\)"
EMPTY_LINK = r"\[[ \t]*\]\([^)\n]*\)"
LABEL = r"\[([^\]\n]+)\]"
HEADING = r"(?md)^[ \t]{0,3}#{1,6}[ \t]+(.+)$"
PAGE_MARK = r"(?i)^[ \t]{0,3}#{1,6}[ \t]+Page[ \t]+([0-9]+)[ \t]*$"


def plain_line(line) -> Column:
    """The line without its list mark, lower-cased: what the noise rules look at."""
    return F.lower(trim(F.regexp_replace(col(line), LIST_MARK, "")))


def _starts_or_prefixes(first: Column, other: Column) -> Column:
    return (other != "") & (first.startswith(other) | other.startswith(first))


def _repeats_first_word(words: Column) -> Column:
    """Two to four words where a later one starts with the first one, or the reverse."""
    first = F.get(words, F.lit(0))
    return (
        F.size(words).between(2, 4)
        & (first != "")
        & F.exists(
            F.slice(words, 2, 3),
            lambda w: let(
                F.regexp_replace(w, r"[.…]+$", ""), lambda x: _starts_or_prefixes(first, x)
            ),
        )
    )


def is_noise_plain(plain) -> Column:
    """The ordered noise rules on an already prepared line."""
    p = col(plain)
    words = F.split(p, r"(?U)\s+", 6)
    repeats = let(words, _repeats_first_word)
    prefix = F.lit(False)
    for x in K.NOISE_PREFIXES:
        prefix = prefix | p.startswith(x)
    return (
        (p == "")
        | (~p.contains("|") & p.rlike(SEPARATOR))
        | p.isin(K.NOISE_LINES)
        | p.rlike(REPEATED_WORD)
        | repeats
        | ((F.length(p) <= 160) & p.rlike(FOOTER))
        | (p.contains("@") & p.rlike(EMAIL))
        | ((p.startswith("jl") | p.startswith("jalan")) & p.rlike(STREET))
        | (p.startswith("menampilkan") & p.rlike(LIST_COUNTER))
        | (p.contains("/") & p.rlike(PAGE_SIZE))
        | p.rlike(PAGE_NUMBER)
        | prefix
    )


def is_noise_line(line) -> Column:
    return let(plain_line(line), is_noise_plain)


def tidy_label(label) -> Column:
    """Cut ellipses, then drop trailing words that repeat or abbreviate the first word."""
    t = rtrim(F.regexp_replace(collapse(label), r"(?:\.\.\.|…)+$", ""))
    return let(F.split(t, " "), _without_repeats)


def _without_repeats(words: Column) -> Column:
    first = F.lower(F.get(words, F.lit(0)))
    keep = F.array_max(
        F.transform(
            words,
            lambda w, i: F.when((i > 0) & ~first.startswith(F.lower(w)), i + 1).otherwise(1),
        )
    )
    return F.array_join(F.slice(words, 1, keep), " ")


def _replace_each(text: Column, pattern: str, group: int, f) -> Column:
    """Replace every match by ``f(captured group)``: split, capture, zip back together."""
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.array_join(
        F.zip_with(parts, found, lambda p, m: F.concat(p, F.coalesce(f(m), F.lit("")))), ""
    )


def tidy_link_labels(text) -> Column:
    def run(t):
        tidied = _replace_each(t, LABEL, 1, lambda m: F.concat(F.lit("["), tidy_label(m), F.lit("]")))
        return F.when(t.contains("["), tidied).otherwise(t)

    return let(col(text), run)


def fix_target(target) -> Column:
    return let(trim(F.translate(col(target), "\\", "/")), _rooted)


def _rooted(t: Column) -> Column:
    keep = (t == "") | t.startswith("/") | t.startswith("#") | t.rlike(r"(?i)^[a-z][a-z0-9+.\-]*:")
    return F.when(keep, t).otherwise(F.concat(F.lit("/"), t))


def fix_link_targets(text) -> Column:
    def run(t):
        fixed = _replace_each(t, r"\]\(([^)\n]*)\)", 1, lambda m: F.concat(F.lit("]("), fix_target(m), F.lit(")")))
        return F.when(t.contains("]("), fixed).otherwise(t)

    return let(col(text), run)


def residue_text(block) -> Column:
    """Text of a block outside links, bullets and emphasis."""
    t = F.regexp_replace(col(block), r"\[[^\]\n]*\]\([^)\n]*\)", " ")
    t = F.regexp_replace(t, r"[#*_`>|~]+", " ")
    t = F.regexp_replace(t, r"(?Um)^\s*(?:[-*+]|\d+[.)])\s+", " ")
    return collapse(t)


def block_kind(block) -> Column:
    """``navigasi`` (links only), ``label`` (short caption) or ``isi`` (content)."""
    b = col(block)
    t = trim(b)
    content = (t == "") | t.rlike(r"(?U)^#{1,6}\s") | t.startswith("|")
    return F.when(content, F.lit("isi")).otherwise(
        let(residue_text(b), lambda r: _kind_by_residue(b, r))
    )


def _kind_by_residue(b: Column, residue: Column) -> Column:
    size = F.length(residue)
    links = F.regexp_count(b, F.lit(LINK_TARGET))
    labels = F.regexp_extract_all(b, F.lit(r"\[([^\]\n]*)\]\([^)\n]*\)"), F.lit(1))
    vocabulary = (F.size(labels) > 0) & F.forall(
        labels, lambda x: F.lower(tidy_label(x)).isin(K.NOISE_LINES)
    )
    targets = F.regexp_extract_all(b, F.lit(r"\]\(([^)\n]*)\)"), F.lit(1))
    contact = F.forall(targets, lambda x: trim(x).rlike("(?i)^(?:tel|mailto|sms|whatsapp):"))
    only_links = (size <= K.NAV_RESIDUE_CHARS) & (links > 0) & ~residue.rlike("[.!?:;]$")
    menu = (size == 0) & ((links >= 2) | vocabulary | contact)
    short = size.between(1, K.LABEL_CHARS) & (links == 0)
    few_words = F.size(F.split(residue, " ")) <= K.LABEL_WORDS
    no_digits = ~residue.rlike(r"(?U)\d") | residue.rlike(r"(?U)^[\d\s()+\-.,/–—]+$")
    return (
        F.when(size > max(K.NAV_RESIDUE_CHARS, K.LABEL_CHARS), F.lit("isi"))
        .when(only_links, F.when(menu, F.lit("label")).otherwise(F.lit("navigasi")))
        .when(short & few_words & no_digits, F.lit("label"))
        .otherwise(F.lit("isi"))
    )


def heading_level(block) -> Column:
    """Number of heading marks at the start of a block, 0 for other blocks."""
    return F.length(F.regexp_extract(col(block), r"(?U)^\s{0,3}(#{1,6})\s+", 1))


def first_heading(markdown) -> Column:
    return trim(F.regexp_replace(F.regexp_extract(col(markdown), HEADING, 1), "[#*_`]+", ""))


def clean_heading(text) -> Column:
    return collapse(F.regexp_replace(col(text), "[#*_`]+", ""))


def plain_text(text) -> Column:
    t = replace_where(text, r"\[([^\]\n]*)\]\([^)\n]*\)", "$1", "](")
    return collapse(replace_where(t, r"[#*_`>|~]+", " ", *"#*_`>|~"))


def _solid(t: Column) -> Column:
    """Number of characters that are no white space."""
    return F.length(F.regexp_replace(F.replace(t, F.lit(" "), F.lit("")), r"(?U)\s+", ""))


def link_ratio(text, plain: Column | None = None) -> Column:
    """Share of the non-space characters that is markup; ``plain``: the plain text, if it is at hand."""
    total = _solid(col(text))
    real = let(plain_text(text), _solid) if plain is None else _solid(plain)
    return let(
        F.struct(total.alias("t"), real.alias("r")),
        lambda n: F.when((n["t"] == 0) | (n["r"] >= n["t"]), F.lit(0.0)).otherwise(
            (n["t"] - n["r"]) / n["t"]
        ),
    )


def clean_chunk_text(text) -> Column:
    """Window text without markdown marks; line structure stays."""
    steps = [  # pattern, replacement, what a text must hold for the pattern to match or change it
        (r"\[([^\]\n]*)\]\([^)\n]*\)", "$1", "]("),
        (r"\[([^\]\n]*)\]", "$1", "["),
        (r"(?m)^[ \t]{0,3}#{1,6}[ \t]*", "", "#"),
        (r"(?<![\p{L}\p{N}])#{1,6}(?![\p{L}\p{N}])", "", "#"),
        (r"\*\*([^*\n]+)\*\*", "$1", "**"),
        (r"__([^_\n]+)__", "$1", "__"),
        (r"~~([^~\n]+)~~", "$1", "~~"),
        (r"`([^`\n]+)`", "$1", "`"),
        (r"(?m)^[ \t]{0,3}>[ \t]?", "", ">"),
        (r"[ \t]{2,}|\t", " ", "  ", "\t"),
        (r" \n", "\n", " \n"),
        (r"\n{3,}", "\n\n", "\n\n\n"),
    ]
    t = col(text)
    for pattern, replacement, *marks in steps:
        t = replace_where(t, pattern, replacement, *marks)
    return trim(t)


def headings(markdown) -> Column:
    """array<struct(offset, text)> of the headings, in order; offsets in characters.

    One Arrow pass: a column expression would be worked out again for each use of what it finds.
    """
    line, mark = re.compile(HEADING.replace("(?md)", "(?m)")), re.compile(r"[ \t]{0,3}#{1,6}[ \t]+")
    parts = pa.struct([("offset", pa.int32()), ("text", pa.string())])

    @F.arrow_udf("array<struct<offset:int,text:string>>")
    def run(texts: pa.Array) -> pa.Array:
        ends, offsets, names = [0], [], []
        for v in texts:
            t = v.as_py() or ""
            # a text without a mark has no heading; its lines need not be looked at
            for m in line.finditer(t) if "#" in t else ():
                offsets.append(m.start())
                names.append(mark.sub("", m.group(0), count=1))
            ends.append(len(names))
        rows = pa.StructArray.from_arrays([pa.array(offsets, pa.int32()), pa.array(names, pa.string())], fields=list(parts))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=texts.is_null())

    return run(col(markdown))


def heading_texts(found) -> Column:
    """Cleaned, non-empty headings."""
    cleaned = F.transform(
        col(found),
        lambda h: F.struct(h["offset"].alias("offset"), clean_heading(h["text"]).alias("text")),
    )
    return F.filter(cleaned, lambda h: h["text"] != "")


def page_marks(found) -> Column:
    """array<struct(offset, page)> from headings of the form ``Page <n>``."""
    pages = F.transform(
        col(found),
        lambda h: F.struct(
            h["offset"].alias("offset"),
            F.regexp_extract(h["text"], r"(?i)^Page[ \t]+([0-9]+)[ \t]*$", 1).alias("page"),
        ),
    )
    return F.transform(
        F.filter(pages, lambda p: p["page"] != ""),
        lambda p: F.struct(p["offset"].alias("offset"), p["page"].cast("int").alias("page")),
    )


def headings_at(found, starts, lengths) -> Column:
    """array<string>, as-of for each window: last heading at or before its start; else the last one inside it."""
    h, ends = col(found), F.zip_with(col(starts), col(lengths), lambda s, n: s + n)
    offsets = F.transform(h, lambda x: x["offset"])
    places = F.arrays_zip(
        last_before(offsets, col(starts)).alias("before"), last_before(offsets, ends, inclusive=False).alias("inside"))

    def text(p):
        # nothing stands before the window, so what ends before its end stands inside it
        at = F.when(p["before"] >= 0, p["before"]).otherwise(p["inside"])
        return F.get(h, at)["text"]

    return F.transform(places, text)


def pages_at(marks, starts) -> Column:
    """array<int>, as-of for each window: last page mark at or before its start, else the first mark."""
    m = col(marks)
    places = last_before(F.transform(m, lambda x: x["offset"]), col(starts))
    return F.transform(places, lambda p: F.get(m, F.greatest(p, F.lit(0)))["page"])


def heading_at(found, start, length) -> Column:
    """``headings_at`` for a single window."""
    return F.get(headings_at(found, F.array(col(start)), F.array(col(length))), F.lit(0))


def page_at(marks, start) -> Column:
    """``pages_at`` for a single window."""
    return F.get(pages_at(marks, F.array(col(start))), F.lit(0))
