"""Content services of sites: rules as rows, the first rule of an address, and page texts from JSON answers."""

from __future__ import annotations

import json
import re
from re import _constants as C
from re import _parser as P

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import collapse, decode_entities, let, normalize_whitespace, one_line, trim
from docloom.operators.htmlmd import html_to_markdown
from docloom.operators.jsonwalk import dig_text, fill_endpoint

RULE = "match string, url string, field string, title_field string, format string, min_length int, timeout int"
GRAM = 3  # characters of the literal piece under which a rule is looked up


def _rule_list(value) -> list:
    """The rules of one configured value: a string, an object, a list, ``{"rules": ...}`` or ``{"enabled": false}``."""
    if isinstance(value, str):
        return [{"url": value}]
    if isinstance(value, dict):
        if not value.get("enabled", True):
            return []
        value = value.get("rules", value)
        if isinstance(value, dict):
            value = [value] if "url" in value or "endpoint" in value else list(value.values())
    return [r for r in value if isinstance(r, dict)] if isinstance(value, list) else []


def _number(value) -> int:
    try:
        return max(0, int(value or 0))
    except (TypeError, ValueError):
        return 0


def _normalized(rule: dict) -> dict | None:
    def text(*names, default=""):
        found = next((rule[n] for n in names if rule.get(n) is not None), default)
        return str(found).strip()

    url = text("url", "endpoint")
    return url and {
        "match": text("match", "url_pattern"), "url": url, "field": text("field", "content_field"), "title_field": text("title_field", "titleField"),
        "format": "text" if text("format", default="html").lower() == "text" else "html",
        "min_length": _number(rule.get("min_length", rule.get("minLength"))), "timeout": _number(rule.get("timeout")),
    } or None


def api_rules(sites: DataFrame, site: str, config: str) -> DataFrame:
    """(site, rule_no, match, url, field, title_field, format, min_length, timeout): the rules of each site's JSON value, from 1.

    Rules without an endpoint and values of other kinds are left out; broken JSON is a plain endpoint only if
    it is an address.
    """

    @F.pandas_udf(f"array<struct<{','.join(x.strip().replace(' ', ':') for x in RULE.split(','))}>>")
    def parsed(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None:
                return []
            try:
                value = json.loads(v)
            except ValueError:
                value = v if re.match(r"\s*https?://", v, re.I) else None
            return [n for n in map(_normalized, _rule_list(value)) if n]

        return values.map(one)

    rows = sites.select(F.col(site).alias("site"), F.posexplode(parsed(F.col(config))).alias("i", "r"))
    return rows.select("site", (F.col("i") + 1).alias("rule_no"), "r.*")


def literal_piece(pattern: str) -> str:
    """Longest run of plain characters that every match of a pattern holds, in lower case; '' if none is sure."""
    best = run = ""
    todo = list(P.parse(pattern))
    i = 0
    while i < len(todo):
        op, x = todo[i]
        if op is C.SUBPATTERN and not x[1] and not x[2]:
            todo[i : i + 1] = list(x[3])
            continue
        if op is C.LITERAL and x < 128:
            run += chr(x).lower()
        else:
            run = "" if op is not C.AT else run
        best = max(best, run, key=len)
        i += 1
    return best


def indexed_rules(rules: DataFrame) -> DataFrame:
    """Add ``piece``: the first ``GRAM`` characters of the literal part of the pattern, '' where a rule must always be
    tried, NULL where the pattern is broken and never matches."""

    def one(pattern):
        try:
            found = literal_piece(pattern or "")
        except re.error:
            return None
        return found[:GRAM] if len(found) >= GRAM else ""

    @F.pandas_udf("string")
    def piece(patterns: pd.Series) -> pd.Series:
        return patterns.map(one)

    return rules.withColumn("piece", piece("match"))


def first_rules(pages: DataFrame, rules: DataFrame, key: str, url: str) -> DataFrame:
    """(key, site, rule, groups): for each page (key, site, url) its site's first rule whose pattern matches, with capture groups.

    ``rules`` comes from ``api_rules``.  An address meets a rule under a literal piece that all its matches hold (or
    always, if the pattern has none), only then is the pattern tried, case ignored; '' matches all.  So a site may
    have thousands of rules.  Pages without a matching rule have no row.
    """
    r = indexed_rules(rules).select("site", "rule_no", F.struct(*rules.columns).alias("rule"), F.col("match").alias("__match"), "piece")
    low = F.lower(F.col(url))
    starts = F.sequence(F.lit(1), F.greatest(F.length(low) - GRAM + 1, F.lit(1)))
    grams = let(low, lambda u: F.array_distinct(F.concat(F.array(F.lit("")), F.transform(starts, lambda i: F.substr(u, i, F.lit(GRAM))))))
    p = pages.select(F.col(key).alias(key), "site", F.col(url).alias("__url"), F.explode(grams).alias("piece"))
    hits = p.join(r, ["site", "piece"]).filter((F.col("__match") == "") | F.expr("__url rlike concat('(?i)', __match)"))
    best = hits.groupBy(key, "site", "__url").agg(F.min_by("rule", "rule_no").alias("rule"))
    return best.withColumn("groups", _groups(F.col("__url"), F.col("rule.match"))).drop("__url")


def _groups(url, pattern):
    @F.pandas_udf("array<string>")
    def found(urls: pd.Series, patterns: pd.Series) -> pd.Series:
        def one(u, p):
            m = re.search(p, u, re.I) if p else None
            return [x or "" for x in m.groups()] if m else []

        return pd.Series([one(u, p) for u, p in zip(urls, patterns)])

    return found(url, pattern)


def content_pages(pages: DataFrame, rules: DataFrame, answers: DataFrame, key: str, url: str) -> DataFrame:
    """(key, endpoint, markdown, title, field, galat): page texts from the services of their sites.

    ``answers`` (endpoint, http, body) are what the services said, one row an endpoint.  The page's first rule names the endpoint and
    the field; a field that is empty, an answer that is missing, no success or no JSON, and a text below ``min_length`` give
    ``galat`` and no markdown.  Format ``text`` drops marks, ``html`` is rendered like any page; a title comes from
    ``title_field``, else from the HTML.
    """
    m = first_rules(pages, rules, key, url).join(pages.select(key, F.col(url).alias("__url")), key)
    m = m.withColumn("endpoint", fill_endpoint(F.col("rule.url"), "__url", "groups"))
    m = m.select(key, "endpoint", F.col("rule.field").alias("field"), F.col("rule.title_field").alias("tf"), F.col("rule.format").alias("format"), F.col("rule.min_length").alias("least"))
    j = m.join(answers.select("endpoint", "http", "body"), "endpoint", "left")
    raw = F.when(F.col("field") == "", trim("body")).otherwise(dig_text("body", "field"))
    j = j.withColumn("raw", F.coalesce(raw, F.lit(""))).withColumn("own", F.when(F.col("tf") != "", collapse(dig_text("body", "tf"))))
    is_json = F.try_parse_json("body").isNotNull()
    shown = F.when(F.col("field") == "", F.lit("<badan>")).otherwise(F.col("field"))
    galat = (
        F.when(F.col("endpoint") == "", F.lit("template url aturan tidak valid"))
        .when(F.col("http").isNull() | ~F.col("http").between(200, 299), F.concat(F.lit("HTTP "), F.coalesce(F.col("http"), F.lit(0)).cast("string")))
        .when((F.col("field") != "") & ~is_json, F.lit("respons bukan JSON"))
        .when(F.col("raw") == "", F.concat(F.lit("field "), shown, F.lit(" kosong"))))
    j = j.withColumn("galat", galat).withColumn("field", shown)
    rendered = html_to_markdown(j.filter("galat is null and format = 'html'").select(F.col(key).alias("page_id"), F.col("raw").alias("html")))
    rendered = rendered.select(F.col("page_id").alias(key), F.col("markdown").alias("__md"), F.col("title").alias("__title"))
    plain = normalize_whitespace(decode_entities(F.regexp_replace("raw", r"(?s)<[^>]*>", "")))
    j = j.join(rendered, key, "left").withColumn("markdown", F.when(F.col("galat").isNull(), F.when(F.col("format") == "text", plain).otherwise(trim(F.coalesce("__md", F.lit(""))))))
    n = F.length("markdown")
    short = (F.col("markdown") == "") | (n < F.col("least"))
    said = F.concat(F.lit("isi terlalu pendek ("), n.cast("string"), F.lit(" < "), F.col("least").cast("string"), F.lit(" karakter)"))
    j = j.withColumn("galat", F.coalesce("galat", F.when(short, said)))
    ok = F.col("galat").isNull()
    title = F.coalesce(F.nullif(F.col("own"), F.lit("")), trim("__title"), F.lit(""))
    return j.select(key, "endpoint", F.when(ok, F.col("markdown")).alias("markdown"), F.when(ok, one_line(title, 240)).alias("title"), "field", "galat")
