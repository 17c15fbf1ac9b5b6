"""HTML to Markdown as token rows: one explode, one shuffle by page, then windows.

A page is cut into tag and text tokens.  All later steps are window functions and
groupings whose keys start with the page key, so the single hash partitioning by page
serves every one of them.  A group never exceeds one page.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.html import COMMENT, attribute, document_title
from docloom.functions.text import decode_entities, let, normalize_whitespace, replace_where, trim

#: Pages whose tokens one task sorts, about.
PAGES_PER_TASK = 1000

_SPACES = r"\s{2,}|[^\S ]"  # runs of white space that are not one space already
_TOKEN = r"<[!/?a-zA-Z][^>]*>|<|[^<]+"
_DROP = set(K.DROP_TAGS) | set(K.NAVIGATION_TAGS)
# elements whose end tag is commonly left out never open a dropped region
_DROP_REGION = sorted(_DROP - {"option", "input"})
_LEAF = ["dt", "dd", "figcaption", "summary", "address"]
_HEAD = [f"h{i}" for i in range(1, 7)]
_LISTS = ["ul", "ol"]
_TABLE_PARTS = ["table", "thead", "tbody", "tr", "td", "th"]
_BOUNDARY = sorted((set(K.BLOCK_TAGS) | set(K.DROP_TAGS) | {"td", "th"}))

# control characters that stand for inline markup until a block is complete
_A1, _A2, _A3 = "\u0002", "\u0003", "\u0004"
_INLINE = {  # tag family -> (open, close, markdown mark)
    "strong": ("\u0005", "\u0006", "**"),
    "em": ("\u0007", "\u0008", "*"),
    "code": ("\u000e", "\u000f", "`"),
    "del": ("\u0010", "\u0011", "~~"),
}
_FAMILY = {"strong": "strong", "b": "strong", "em": "em", "i": "em", "code": "code",
           "del": "del", "s": "del", "strike": "del"}


def body_html(html) -> Column:
    """Body markup without comments and raw-text elements."""
    h = F.regexp_replace(F.col(html) if isinstance(html, str) else html, COMMENT, "")
    h = F.regexp_replace(h, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    h = F.regexp_replace(h, r"(?is)<head\b[^>]*>.*?</head\s*>", "")
    return F.regexp_replace(h, r"(?is)^.*?<body\b[^>]*>|</?(?:body|html)\b[^>]*>", "")


def tokens(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, tag, closing, void, noisy, piece, head, tail, n, w): one row per tag or text run.

    ``piece`` is the inline text that the token adds.  Of a text run: ``head`` and ``tail`` tell that no space begins and
    ends it, ``n`` and ``w`` count its non-space characters and words.  What follows sorts these rows many times, so the
    markup itself, and whatever else needs it, stays behind here.
    """
    t = pages.select(key, body_html(html).alias("__body"))
    t = t.select(
        key, F.posexplode(F.regexp_extract_all("__body", F.lit(_TOKEN), F.lit(0))).alias("pos", "raw")
    )
    is_tag = F.col("raw").startswith("<") & (F.col("raw") != "<")
    name = F.lower(F.regexp_extract("raw", r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1))
    t = t.withColumn("tag", F.when(is_tag, name))
    t = t.filter(F.col("tag").isNull() | (F.col("tag") != ""))
    t = t.select(
        key,
        "pos",
        "tag",
        F.col("raw").startswith("</").alias("closing"),
        (F.col("tag").isin(K.VOID_TAGS) | F.col("raw").endswith("/>")).alias("void"),
        F.when(F.col("tag").isNotNull(), F.col("raw")).alias("raw"),
        F.when(F.col("tag").isNull(), decode_entities("raw")).alias("text"),
    )
    tag, closing, raw, text = F.col("tag"), F.col("closing"), F.col("raw"), F.coalesce("text", F.lit(""))
    label = F.when(
        raw.rlike(r"(?i)[\s\"'/](?:id|class)\s*="),
        trim(F.concat(attribute("raw", "id"), F.lit(" "), attribute("raw", "class"))),
    )
    noisy = F.coalesce(~closing & raw.isNotNull() & label.rlike("(?i)" + K.NOISE_ATTRIBUTE), F.lit(False))
    t = t.select(
        key,
        "pos",
        "tag",
        "closing",
        "void",
        noisy.alias("noisy"),
        _piece(tag, closing, raw, F.col("text")).alias("piece"),
        F.when(text != "", ~text.rlike(r"^\s")).alias("head"),
        # a space at the end stands before one line end at most
        F.when(text != "", ~F.substring(text, -2, 2).rlike(r"\s$")).alias("tail"),
        F.btrim(F.regexp_replace(text, _SPACES, " "), F.lit(" ")).alias("__words"),
    )
    t = t.withColumn("n", F.length(F.replace("__words", F.lit(" "), F.lit(""))))
    spaces = F.length("__words") - F.col("n")
    return t.withColumn("w", F.when(F.col("n") == 0, 0).otherwise(spaces + 1)).drop("__words")


def _piece(tag: Column, closing: Column, raw: Column, text: Column) -> Column:
    """The inline text of a token; the end tag of a link renders the address of the last start tag."""
    href, src = trim(attribute(raw, "href")), trim(attribute(raw, "src"))
    alt = trim(decode_entities(attribute(raw, "alt")))
    linked = let(
        href,
        lambda h: F.when((h != "") & ~h.rlike("(?i)^(#|javascript:)"), F.concat(F.lit(_A1), h, F.lit(_A2))),
    )
    image = let(src, lambda v: F.when(v != "", F.concat(F.lit("!["), alt, F.lit("]("), v, F.lit(")"))))
    piece = F.when(tag.isNull(), text)
    piece = piece.when(tag == "br", F.lit("\n")).when(tag == "img", image)
    piece = piece.when(tag == "a", F.when(closing, F.lit(_A3)).otherwise(linked))
    for name, family in _FAMILY.items():
        start, stop, _ = _INLINE[family]
        piece = piece.when(tag == name, F.when(closing, F.lit(stop)).otherwise(F.lit(start)))
    return F.coalesce(piece, F.lit(""))


def _with_depths(df: DataFrame, key: str, depths: dict[str, list[str]]) -> DataFrame:
    """Nesting depth after each token, never below zero on stray end tags."""
    w = W.partitionBy(key).orderBy("pos")
    sums = {}
    for out, tags in depths.items():
        counted = F.col("tag").isin(tags) & ~F.col("void")
        delta = F.when(counted, F.when(F.col("closing"), -1).otherwise(1)).otherwise(0)
        sums[f"__{out}"] = F.sum(delta).over(w)
    df = df.select("*", *[c.alias(n) for n, c in sums.items()])
    depth = {
        out: (F.col(f"__{out}") - F.least(F.min(f"__{out}").over(w), F.lit(0))).cast("int")
        for out in depths
    }
    return df.select("*", *[c.alias(n) for n, c in depth.items()]).drop(*sums)


def _following(name: str) -> Column:
    """The next value of a column that is not null, as a window function."""
    return F.expr(f"lead(`{name}`) IGNORE NULLS")


def _with_spans(df: DataFrame, key: str) -> DataFrame:
    """Add ``end`` and ``chars`` of each element and ``page_chars`` of the whole page.

    Elements of one name at one nesting level alternate start and end, so the partner of a
    start tag is the next row of that level.  A paragraph also ends before the next block
    boundary.  The collapsed text length of a span is its non-space characters plus one space
    between words, so running counts at both ends are enough: no row looks at its span.
    """
    w = W.partitionBy(key).orderBy("pos")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    # all that goes by position alone is worked out in one order of the rows
    df = df.select(
        "*",
        F.coalesce(_following("head").over(w), F.lit(False)).alias("__next"),
        F.coalesce(F.last("tail", ignorenulls=True).over(before), F.lit(False)).alias("__open"),
        F.sum("n").over(w).alias("__cn"),
    )
    joined = (F.coalesce("head", F.lit(False)) & F.col("__open")).cast("int")
    df = df.withColumn("__cw", F.sum(F.col("w") - joined).over(w))
    sums = F.struct("pos", "__cn", "__cw")
    is_boundary = F.coalesce(F.col("tag").isin(_BOUNDARY), F.lit(False))
    df = df.withColumn("__edge", F.when(is_boundary, sums))
    df = df.withColumn("__bound", _following("__edge").over(w))
    df = df.withColumn("__all", F.max(sums).over(W.partitionBy(key)))

    by_tag = W.partitionBy(key, "tag").orderBy("pos")
    element = F.col("tag").isNotNull() & ~F.col("void")
    start = element & ~F.col("closing")
    delta = F.when(element, F.when(F.col("closing"), -1).otherwise(1)).otherwise(0)
    df = df.withColumn("__s", F.sum(delta).over(by_tag))
    df = df.withColumn("__d", F.col("__s") - F.least(F.min("__s").over(by_tag), F.lit(0)))
    df = df.withColumn("__level", F.col("__d") + F.col("closing").cast("int"))
    level = W.partitionBy(key, "tag", "__level").orderBy("pos")
    df = df.withColumn("__pair", F.lead(F.when(F.col("closing"), sums)).over(level))
    past_end = F.struct(
        (F.col("__all.pos") + 1).alias("pos"), F.col("__all.__cn"), F.col("__all.__cw")
    )
    df = df.withColumn(
        "__stop",
        F.when(start & (F.col("tag") == "p"), F.coalesce(F.col("__bound"), past_end)).when(
            start, F.col("__pair")
        ),
    )
    n = F.col("__stop.__cn") - F.col("__cn")
    continued = (F.col("__open") & F.col("__next")).cast("int")
    words = F.col("__stop.__cw") - F.col("__cw") + continued
    df = df.withColumn("end", F.col("__stop.pos"))
    df = df.withColumn("chars", F.when(n == 0, 0).otherwise(n + words - 1))
    total = F.col("__all.__cn")
    df = df.withColumn(
        "page_chars", F.when(total == 0, 0).otherwise(total + F.col("__all.__cw") - 1)
    )
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _content_tokens(t: DataFrame, key: str, strip_navigation: bool) -> DataFrame:
    """Tokens of the content root, with dropped and noisy elements removed."""
    drop = _DROP_REGION if strip_navigation else sorted(set(K.DROP_TAGS) - {"option", "input"})
    t = _with_depths(t, key, {"drop": drop})
    t = t.filter((F.col("drop") == 0) & ~F.coalesce(F.col("tag").isin(drop + ["option", "input"]), F.lit(False)))
    t = t.drop("drop")
    w = W.partitionBy(key).orderBy("pos")
    if strip_navigation:
        t = _with_spans(t, key)
        bad = F.col("noisy") & (F.col("chars") < K.NOISE_ELEMENT_CHARS)
        t = t.withColumn("__cover", F.max(F.when(bad, F.col("end"))).over(w))
        t = t.filter(F.coalesce(F.col("pos") > F.col("__cover"), F.lit(True)))
        t = t.drop("__cover", "end", "chars", "page_chars")
    t = _with_spans(t.drop("noisy"), key)
    page = W.partitionBy(key)
    limit = F.floor(F.col("page_chars") * K.ROOT_SHARE)
    fits = (
        (F.col("page_chars") >= K.ROOT_MIN_CHARS)
        & (F.col("chars") >= limit)
        & (F.col("chars") < F.col("page_chars"))
    )
    root = F.min(F.when(fits, F.struct("chars", "pos", "end"))).over(page)
    t = t.withColumn("__root", root)
    inside = (F.col("pos") > F.col("__root.pos")) & (F.col("pos") < F.col("__root.end"))
    return t.filter(F.col("__root").isNull() | inside).select(key, "pos", "tag", "closing", "void", "piece")


def _pieces(t: DataFrame, key: str) -> DataFrame:
    """Annotate tokens with the block they belong to."""
    w = W.partitionBy(key).orderBy("pos")
    t = _with_depths(
        t,
        key,
        {"list_depth": _LISTS, "table_depth": ["table"], "quote": ["blockquote"], "pre": ["pre"]},
    )
    tag, closing = F.col("tag"), F.col("closing")
    in_list = (F.col("list_depth") > 0) | tag.isin(_LISTS)
    in_table = (F.col("table_depth") > 0) | (tag == "table")
    boundary = (
        F.when(F.col("pre") > 0, (tag == "pre"))
        .when(in_table, tag.isin(_TABLE_PARTS))
        .when(in_list, tag.isin("li", *_LISTS))
        .otherwise(tag.isin(_BOUNDARY))
    )
    t = t.withColumn("__cut", F.coalesce(boundary, F.lit(False)))
    t = t.select(
        "*",
        F.sum(F.col("__cut").cast("int")).over(w).alias("block"),
        F.last(F.when(F.col("__cut"), F.struct(tag, closing)), ignorenulls=True)
        .over(w)
        .alias("opener"),
        F.sum(((tag == "table") & ~closing).cast("int")).over(w).alias("table_no"),
        F.sum(((tag == "tr") & ~closing).cast("int")).over(w).alias("row_no"),
    )
    # list context: the list that holds an item is the last one opened at the same depth
    at_depth = W.partitionBy(key, "list_depth").orderBy("pos")
    opens_list = tag.isin(_LISTS) & ~closing
    t = t.withColumn("__list", F.last(F.when(opens_list, F.struct("pos", "tag")), True).over(at_depth))
    items = W.partitionBy(key, "list_depth", "__list.pos").orderBy("pos")
    t = t.withColumn("item_no", F.sum(((tag == "li") & ~closing).cast("int")).over(items))
    t = t.withColumn("ordered", F.col("__list.tag") == "ol")
    # a token without text counts only where it begins a block
    return t.filter((F.col("piece") != "") | F.col("__cut") | (F.col("block") == 0))


def _squeeze(c: Column) -> Column:
    return trim(F.regexp_replace(c, _SPACES, " "))


def _finish_inline(c: Column) -> Column:
    """Turn control characters into markdown, innermost constructs first."""
    links = [
        (f"{_A1}[^{_A2}]*{_A2}\\s*{_A3}", ""),
        (f"{_A1}([^{_A2}]*){_A2}\\s*([^{_A1}{_A3}]*?)\\s*{_A3}", "[$2]($1)"),
        (f"{_A1}[^{_A2}]*{_A2}|{_A3}", ""),
    ]
    # each pattern needs one of the marks; most texts have none
    for pattern, replacement in links:
        c = replace_where(c, pattern, replacement, _A1, _A3)
    for start, stop, mark in _INLINE.values():
        c = replace_where(c, f"{start}\\s*({stop}|$)", "", start)
        c = replace_where(c, f"{start}\\s*([^{start}{stop}]*?)\\s*({stop}|$)", f"{mark}$1{mark}", start)
        c = replace_where(c, f"[{start}{stop}]", "", start, stop)
    return _squeeze(c)


def _plain_inline(c: Column) -> Column:
    c = F.regexp_replace(c, f"{_A1}[^{_A2}]*{_A2}|[\u0004-\u0008\u000e-\u0011]", "")
    return _squeeze(c)


def blocks(t: DataFrame, key: str) -> DataFrame:
    """(key, block, markdown): rendered blocks in document order."""
    g = t.groupBy(key, "block").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), ""
        ).alias("inline"),
        F.min_by(
            F.struct("opener", "list_depth", "table_depth", "quote", "pre", "item_no", "ordered",
                     "table_no", "row_no"),
            "pos",
        ).alias("c"),
    )
    opener, opened = F.col("c.opener.tag"), ~F.col("c.opener.closing")
    kind = (
        F.when((F.col("c.table_depth") > 0), F.when(opener.isin("td", "th") & opened, F.lit("cell")))
        .when(F.col("c.pre") > 0, F.lit("pre"))
        .when(F.col("c.list_depth") > 0, F.when((opener == "li") & opened, F.lit("item")))
        .when((opener == "hr"), F.lit("rule"))
        .when(opener.isin(_HEAD) & opened, F.lit("head"))
        .when(opener.isin("li", *_LEAF) & opened, F.lit("leaf"))
        .otherwise(F.lit("text"))
    )
    g = g.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    g = g.withColumn("inline", decode_entities("inline"))
    rich, plain = _finish_inline(F.col("inline")), _plain_inline(F.col("inline"))
    mark = F.when(F.col("c.ordered"), F.concat(F.col("c.item_no").cast("string"), F.lit(". "))).otherwise(
        F.lit("- ")
    )
    indent = F.repeat(F.lit("  "), F.greatest(F.col("c.list_depth") - 1, F.lit(0)))
    hashes = F.repeat(F.lit("#"), F.coalesce(F.substring(F.col("c.opener.tag"), 2, 1).try_cast("int"), F.lit(0)))
    g = g.withColumn(
        "body",
        F.when(F.col("kind").isin("head", "leaf"), plain)
        .when(F.col("kind") == "pre", F.regexp_replace("inline", r"\s+$", ""))
        .when(F.col("kind") == "rule", F.lit("---"))
        .otherwise(rich),
    )
    # a table is one block of rows of cells; every other block is a single row with one cell
    is_cell = F.col("kind") == "cell"
    g = g.select(
        key,
        F.when(is_cell, F.col("c.table_no")).otherwise(-F.col("block") - 1).alias("unit"),
        F.when(is_cell, F.col("c.row_no")).otherwise(0).alias("row_no"),
        "block",
        (F.col("c.quote") > 0).alias("quoted"),
        F.when(is_cell, F.replace("body", F.lit("|"), F.lit("\\|")))
        .when(trim(F.col("body")) == "", F.lit(None))
        .when(F.col("kind") == "head", F.concat(hashes, F.lit(" "), F.col("body")))
        .when(F.col("kind") == "item", F.concat(indent, mark, F.col("body")))
        .when(F.col("kind") == "pre", F.concat(F.lit("```\n"), F.col("body"), F.lit("\n```")))
        .otherwise(F.col("body"))
        .alias("body"),
    )
    rows = g.groupBy(key, "unit", "row_no").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("block", "body"))), lambda x: x["body"]
        ).alias("cells"),
        F.min("block").alias("block"),
        F.bool_or("quoted").alias("quoted"),
    )
    # blocks without text go here: a filter on their text would slip below and have it rendered twice
    rows = rows.filter((F.col("unit") >= 0) | F.get("cells", F.lit(0)).isNotNull())
    units = rows.groupBy(key, "unit").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("row_no", "cells"))), lambda x: x["cells"]
        ).alias("rows"),
        F.max(F.size("cells")).alias("n"),
        F.min("block").alias("block"),
        F.bool_or("quoted").alias("quoted"),
    )
    lines = F.transform(
        F.col("rows"),
        lambda r, i: F.concat(
            F.lit("| "),
            F.array_join(F.concat(r, F.array_repeat(F.lit(""), F.col("n") - F.size(r))), " | "),
            F.lit(" |"),
            F.when(i == 0, F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), F.col("n")))).otherwise(
                F.lit("")
            ),
        ),
    )
    text = F.when(F.col("unit") < 0, F.get(F.get("rows", F.lit(0)), F.lit(0))).otherwise(
        F.array_join(lines, "\n")
    )
    marked = F.concat(F.lit("> "), F.replace("__text", F.lit("\n"), F.lit("\n> ")))
    return units.withColumn("__text", text).select(
        key, "block", F.when(F.col("quoted"), marked).otherwise(F.col("__text")).alias("markdown")
    )


def html_to_markdown(
    pages: DataFrame, key: str = "page_id", html: str = "html", strip_navigation: bool = True, keep: dict[str, Column] | None = None
) -> DataFrame:
    """(key, title, markdown) for every page; pages without content get ''.

    ``keep``: further columns by name, read in the scan that reads the titles.
    """
    keep = keep or {}
    t = tokens(pages, key, html)
    # one hash partitioning serves all windows; its tasks follow the pages, so none sorts more of them on a larger table
    n = math.ceil(pages.count() / PAGES_PER_TASK)
    if n > int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        t = t.repartition(n, key)
    t = _content_tokens(t, key, strip_navigation)
    b = blocks(_pieces(t, key), key)
    md = b.groupBy(key).agg(
        normalize_whitespace(
            F.array_join(
                F.transform(
                    F.sort_array(F.collect_list(F.struct("block", "markdown"))),
                    lambda x: x["markdown"],
                ),
                "\n\n",
            )
        ).alias("markdown")
    )
    heads = pages.select(key, document_title(html).alias("title"), *[c.alias(n) for n, c in keep.items()])
    return heads.join(md, key, "left").select(
        key, "title", *keep, F.coalesce("markdown", F.lit("")).alias("markdown")
    )
