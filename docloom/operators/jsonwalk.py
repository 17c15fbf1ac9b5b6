"""Walk JSON responses for documents, dig fields, list certificate hosts and drive folders."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import urls as U
from docloom.functions.decisions import extension_allowed
from docloom.functions.text import col, decode_entities, let, one_line, trim
from docloom.operators.skew import top_per_key


def dig(json_text, path: str) -> Column:
    """Value at a dotted path as text; NULL when any step is missing."""
    keys = [k.strip() for k in path.split(".") if k.strip()]
    steps = "".join(f"[{k}]" if k.isdigit() else f"['{k}']" for k in keys)
    return F.get_json_object(col(json_text), "$" + steps)


def number_text(value: int | float) -> str:
    """Number as text: whole floats without a fraction, at most 14 digits, exponents as in ``1.0E+20``."""
    if isinstance(value, int) and -(1 << 63) <= value < 1 << 63:
        return str(value)
    digits, _, power = format(float(value), ".14G").partition("E")
    if not power:
        return digits
    return f"{digits if '.' in digits else digits + '.0'}E{'+' if int(power) >= 0 else '-'}{abs(int(power))}"


def _texts(value, depth: int, max_depth: int | None, max_parts: int | None) -> str:
    if isinstance(value, bool):
        return ""
    if isinstance(value, str):
        return value.strip()
    if isinstance(value, (int, float)):
        return number_text(value)
    if not isinstance(value, (dict, list)) or max_depth is not None and depth > max_depth:
        return ""
    items = value.values() if isinstance(value, dict) else value
    parts = [t for t in (_texts(v, depth + 1, max_depth, max_parts) for v in items) if t]
    return "\n\n".join(parts[:max_parts]).strip()


def flatten_json(json_text, max_depth: int | None = 4, max_parts: int | None = None) -> Column:
    """All text and numbers of a JSON value, joined by blank lines.

    ``max_depth``: levels below the top that are read, None for all (the default is the depth the flattened
    form has); ``max_parts``: parts of one level, None for all.
    """

    @F.pandas_udf("string")
    def flat(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return _texts(json.loads(t), 0, max_depth, max_parts)
            except (TypeError, ValueError):
                return t.strip() if isinstance(t, str) else ""

        return texts.map(one)

    return flat(col(json_text))


def dig_text(json_text, path) -> Column:
    """All text and numbers below a dotted path, which may be a column; '' for broken JSON or a missing step."""

    def one(text, steps):
        try:
            value = json.loads(text)
            for k in (k.strip() for k in steps.split(".")):
                if k:
                    value = value[int(k)] if isinstance(value, list) else value[k]
        except (TypeError, ValueError, LookupError, AttributeError):
            return ""
        return _texts(value, 0, None, None)

    @F.pandas_udf("string")
    def run(texts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([one(t, p) for t, p in zip(texts, paths)])

    return run(col(json_text), col(path))


def _string_fields(value, max_depth: int | None) -> list[list[tuple[str, str]]]:
    """Per object or list, in document order, a node before its children: its fields that hold text."""
    out, todo = [], [(value, 0)]
    while todo:
        node, depth = todo.pop()
        pairs = list(node.items() if isinstance(node, dict) else enumerate(node))
        fields = [(str(k), v.strip()) for k, v in pairs if isinstance(v, str) and v.strip()]
        if fields:
            out.append(fields)
        if max_depth is None or depth < max_depth:
            todo += [(v, depth + 1) for _, v in reversed(pairs) if isinstance(v, (dict, list))]
    return out


def string_fields(json_text, max_depth: int | None = None) -> Column:
    """array<array<struct(name, v)>>: the text fields of every object and list of a JSON text, in one pass."""

    @F.pandas_udf("array<array<struct<name:string,v:string>>>")
    def walk(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                root = json.loads(t)
            except (TypeError, ValueError):
                return []
            found = _string_fields(root, max_depth) if isinstance(root, (dict, list)) else []
            return [[{"name": k, "v": v} for k, v in fields] for fields in found]

        return texts.map(one)

    return walk(col(json_text))


def _is_document(url) -> Column:
    probe = F.when(col(url).rlike("(?i)^https?://"), col(url)).otherwise(F.concat(F.lit("http://contoh.test"), col(url)))
    return U.is_document_link(probe)


def _node_title(fields) -> Column:
    """Title among the text fields of one node: a usual title field first, then the first readable text."""

    def ranked(f, i):
        v, name = f["v"], F.lower(f["name"])
        path_like = (
            v.rlike("(?i)^https?://") | v.startswith("/") | v.rlike(r"(?i)^[a-z0-9._%/\-]+\.(pdf|docx?|xlsx?|pptx?|rtf)$")
        )
        named = F.array_position(F.lit(K.TITLE_KEYS), name).cast("int")
        any_text = ~name.isin(K.SKIP_TITLE_KEYS) & (F.length(v) >= 3)
        rank = F.when(named > 0, named).when(any_text, F.lit(1000))
        usable = ~path_like & ~F.lower(v).isin(K.GENERIC_TITLES) & rank.isNotNull()
        return F.when(usable, F.struct(rank.alias("rank"), i.alias("i"), v.alias("v")))

    return F.coalesce(F.array_min(F.transform(fields, ranked))["v"], F.lit(""))


def json_files(df: DataFrame, key: str, text: str, max_depth: int | None = None) -> DataFrame:
    """(key, url, judul): every document address in a JSON text, with the title beside it.

    Absolute addresses are kept; paths get a leading slash.  The first mention of an address in
    document order keeps its title.  ``max_depth``: levels below the top, None for all.
    """
    nodes = df.select(key, F.posexplode(string_fields(text, max_depth)).alias("node", "fields"))
    nodes = nodes.withColumn("judul", one_line(_node_title("fields"), 240))
    f = nodes.select(key, "node", "judul", F.posexplode("fields").alias("i", "x"))
    v = F.col("x.v")
    rooted = F.concat(F.lit("/"), F.regexp_replace(v, "^/+", ""))
    url = F.when(v.rlike("(?i)^https?://") | v.startswith("/"), v).when(~v.rlike(r"\s"), rooted)
    f = f.select(key, "node", "i", "judul", url.alias("url"))
    f = f.filter(F.col("url").isNotNull() & _is_document("url"))
    return f.groupBy(key, "url").agg(F.min_by("judul", F.struct("node", "i")).alias("judul"))


def _at(value, path: str):
    for step in (k for k in path.split(".") if k.strip()):
        step = step.strip()
        if isinstance(value, dict):
            value = value.get(step)
        elif isinstance(value, list) and step.isdigit() and int(step) < len(value):
            value = value[int(step)]
        else:
            return None
    return value


def _rule_items(root, rule: dict, max_depth: int | None) -> list[tuple[str, str]]:
    """(link, title) of the items that a document rule names, in document order."""
    link_field, children = rule.get("link_field", "file"), rule.get("children_field", "children")
    title_field, out = rule.get("title_field", ""), []

    def consider(item):
        link = _at(item, link_field) if link_field else None
        if isinstance(link, str) and link.strip():
            title = _at(item, title_field) if title_field else None
            if isinstance(title, bool) or not isinstance(title, (str, int, float)):
                title = "1" if title is True else ""
            out.append((link.strip(), title if isinstance(title, str) else number_text(title)))

    start = _at(root, rule["items_field"]) if rule.get("items_field") else root
    todo = [(start, None, 0)]  # a list to walk, or an item to read and then its children
    while todo:
        node, item, depth = todo.pop()
        if item is not None:
            consider(item)
            below = _at(item, children) if children else None
            if isinstance(below, (dict, list)):
                todo.append((below, None, depth + 1))
            continue
        if not isinstance(node, (dict, list)) or max_depth is not None and depth > max_depth:
            continue
        if isinstance(node, dict) and link_field in node:
            consider(node)
        inner = list(node.values() if isinstance(node, dict) else node)
        todo += [(None, x, depth) for x in reversed(inner) if isinstance(x, (dict, list))]
    return out


def rule_files(df: DataFrame, key: str, text: str, endpoint: str, rule: dict, max_depth: int | None = None) -> DataFrame:
    """(key, url, judul): documents that a rule finds in a JSON answer, one row per address and answer.

    ``rule``: ``items_field``, ``children_field``, ``link_field``, ``title_field`` (dotted paths), ``base_url`` and
    ``extensions``; without extensions every document address counts.  The first mention keeps its title.
    """

    @F.pandas_udf("array<struct<link:string,title:string>>")
    def items(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return [{"link": a, "title": b} for a, b in _rule_items(json.loads(t), rule, max_depth)]
            except (TypeError, ValueError):
                return []

        return texts.map(one)

    d = df.select(key, col(endpoint).alias("__endpoint"), F.posexplode(items(col(text))).alias("i", "x"))
    d = d.withColumn("url", file_url(F.col("x.link"), F.lit(rule.get("base_url", "")), "__endpoint")).filter("url <> ''")
    d = d.filter(extension_allowed("url", rule.get("extensions", [])))
    return d.groupBy(key, "url").agg(F.min_by(one_line(F.col("x.title"), 240), "i").alias("judul"))


def file_url(link, base, endpoint) -> Column:
    """Absolute link as it is; else joined to ``base`` or to the host of ``endpoint``."""
    u, b = col(link), F.regexp_replace(F.trim(col(base)), "/+$", "")
    e = col(endpoint)
    from_endpoint = F.concat(U.scheme(e), F.lit("://"), U.host(e))
    b = F.when(b != "", b).when((U.scheme(e) != "") & (U.host(e) != ""), from_endpoint)
    joined = F.concat(b, F.when(u.startswith("/"), u).otherwise(F.concat(F.lit("/"), u)))
    return F.when(u.rlike("(?i)^https?://"), u).otherwise(F.coalesce(joined, F.lit("")))


def fill_endpoint(template, url, groups=None) -> Column:
    """Endpoint template with {slug} {path} {host} {query} {url} {1..n}; '' when one is unknown."""
    t, u = F.trim(col(template)), col(url)
    segments = F.filter(F.split(U.path(u), "/"), lambda s: s != "")
    last = F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit(""))
    values = {
        "{slug}": U._rfc3986(F.regexp_replace(last, r"(?i)\.[a-z0-9]{1,5}$", "")),
        "{path}": F.array_join(F.transform(segments, U._rfc3986), "/"),
        "{host}": U.hostname(u),
        "{query}": U.query(u),
        "{url}": u,
    }
    out = t
    for k, v in values.items():
        out = F.replace(out, F.lit(k), v)
    if groups is not None:
        numbered = F.transform(col(groups), lambda g, i: F.struct(F.concat(F.lit("{"), (i + 1).cast("string"), F.lit("}")).alias("slot"), U._rfc3986(g).alias("g")))
        out = F.aggregate(numbered, out, lambda acc, n: F.replace(acc, n["slot"], n["g"]))
    filled = let(out, lambda o: F.when(~o.rlike(r"(?i)\{[a-z0-9]+\}"), o).otherwise(F.lit("")))
    return F.when(t.rlike("(?i)^https?://"), filled).otherwise(F.lit(""))


def certificate_hosts(df: DataFrame, key: str, text: str, domain: str) -> DataFrame:
    """(key, host): distinct hosts below ``domain`` in certificate-log answers."""
    entries = F.from_json(text, "array<struct<name_value:string,common_name:string>>")
    names = F.flatten(
        F.transform(
            entries,
            lambda e: F.concat(
                F.split(F.coalesce(e["name_value"], F.lit("")), "\n"),
                F.array(F.coalesce(e["common_name"], F.lit(""))),
            ),
        )
    )
    d = df.select(key, col(domain).alias("__d"), F.explode(names).alias("n"))
    h = F.regexp_replace(F.lower(trim("n")), r"^[*.]+", "")
    d = d.select(key, "__d", h.alias("host"))
    ok = (F.col("host") != "") & ~F.col("host").contains("*")
    return d.filter(ok & F.col("host").endswith(F.concat(F.lit("."), F.col("__d")))).select(
        key, "host"
    ).distinct()


def candidate_hosts(domains: DataFrame, domain: str, cert: DataFrame | None = None, limit: int = 80) -> DataFrame:
    """(domain, host): heuristic prefixes first, then certificate hosts, at most ``limit`` each; 0 for all."""
    prefixes = ["", *K.DISCOVERY_PREFIXES]
    d = domains.select(domain, F.posexplode(F.lit(prefixes)).alias("ord", "p")).filter(F.col("p") != "")
    d = d.select(domain, "ord", F.concat("p", F.lit("."), F.col(domain)).alias("host"))
    if cert is not None:
        d = d.unionByName(cert.select(domain, F.lit(len(prefixes)).alias("ord"), "host"))
    d = d.groupBy(domain, "host").agg(F.min("ord").alias("ord"))
    if limit <= 0:
        return d.select(domain, "host")
    return top_per_key(d, [domain], [F.col("ord"), F.col("host")], limit).select(domain, "host")


def folder_files(html) -> Column:
    """array<struct(id, nama)> of a shared folder listing, both page shapes, first id wins."""
    h = col(html)
    entry = r'(?s)id="entry-([A-Za-z0-9_\-]{10,})".*?class="flip-entry-title"[^>]*>([^<]+)<'
    ids1 = F.regexp_extract_all(h, F.lit(entry), F.lit(1))
    names1 = F.regexp_extract_all(h, F.lit(entry), F.lit(2))
    inner = F.regexp_extract(h, r"(?s)window\['_DRIVE_ivd'\]\s*=\s*'(.*?)';", 1)
    inner = F.replace(F.replace(inner, F.lit("\\x22"), F.lit('"')), F.lit("\\x5b"), F.lit("["))
    inner = F.replace(F.replace(inner, F.lit("\\x5d"), F.lit("]")), F.lit('\\"'), F.lit('"'))
    item = r'"([A-Za-z0-9_\-]{10,})",\["?[^\]]*?"?\],"([^"]{1,200})","([^"]*)"'
    ids2 = F.regexp_extract_all(inner, F.lit(item), F.lit(1))
    names2 = F.regexp_extract_all(inner, F.lit(item), F.lit(2))
    both = F.concat(
        F.zip_with(ids1, names1, lambda i, n: F.struct(i.alias("id"), decode_entities(trim(n)).alias("nama"))),
        F.zip_with(ids2, names2, lambda i, n: F.struct(i.alias("id"), decode_entities(trim(n)).alias("nama"))),
    )
    return let(
        both,
        lambda xs: F.slice(
            F.filter(xs, lambda x, i: F.array_position(xs["id"], x["id"]) == i + 1), 1, 500
        ),
    )


def network_log_urls(df: DataFrame, key: str, log: str, page_url: str) -> DataFrame:
    """(key, url, jenis): documents and API addresses named in a page's network log.

    Other sites, the page itself, assets, trackers and site roots are left out.
    """
    found = F.regexp_extract_all(col(log), F.lit(r"""https?://[^\s"'<>\\]+"""), F.lit(0))
    d = df.select(key, col(page_url).alias("__page"), F.explode(F.array_distinct(found)).alias("url"))
    d = d.withColumn("url", decode_entities("url")).distinct()
    d = d.filter((U.url_key("url") != U.url_key("__page")) & (U.host("url") != ""))
    p = F.lower(U.path("url"))
    same = U.same_family(U.host("url"), U.host("__page"))
    tracker = p.rlike("|".join(w.replace("-", r"\-") for w in K.TRACKER_PATH_KEYWORDS))
    api = same & (F.btrim(p, F.lit("/")) != "") & ~U.extension("url").isin(K.ASSET_EXTENSIONS) & ~tracker
    kind = F.when(U.is_document_url("url") | (same & U.looks_like_download("url")), F.lit("berkas")).when(
        api, F.lit("api")
    )
    d = d.withColumn("jenis", kind).filter(F.col("jenis").isNotNull())
    return d.select(key, "url", "jenis", p.contains("/api/").alias("utama"))
