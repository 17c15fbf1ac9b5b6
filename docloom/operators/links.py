"""Link extraction, robots rules and admission of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import urls as U
from docloom.functions.arrays import first_places, last_set
from docloom.functions.html import COMMENT, attribute
from docloom.functions.text import col, let, trim

_TAGS = ["a", "area"] + [t for t, _ in K.EMBEDDED_SOURCES]


def _found_links(tags: Column, base: Column) -> Column:
    """array<struct(rank, pos, link)> of the usable links of a page's tags, in discovery order, each link once."""

    def one(tag, i):
        name = F.lower(F.regexp_extract(tag, r"^<([a-zA-Z]+)", 1))

        def link(n):
            source = F.when(n.isin("a", "area"), attribute(tag, "href"))
            for t, attr in K.EMBEDDED_SOURCES:
                source = source.when(n == t, attribute(tag, attr))
            rank = F.array_position(F.lit(_TAGS), n).cast("int")
            href = let(trim(source), lambda h: F.when(h != "", U.normalize_url(h, base)))
            return F.struct(rank.alias("rank"), i.alias("pos"), href.alias("link"))

        return let(name, link)

    found = F.array_sort(F.filter(F.transform(tags, one), lambda x: x["link"].isNotNull()))
    return let(found, lambda f: F.transform(first_places(F.transform(f, lambda x: x["link"])), lambda p: F.get(f, p)))


def extract_links(
    pages: DataFrame, key: str, url: str, html: str, skip: list[str] | None = None
) -> DataFrame:
    """(key, link, link_no, urutan): unique absolute links of each page in discovery order, numbered from 1.

    Anchors come first, then areas, then embedded sources.  A usable <base> address
    replaces the page address.  All of it happens inside the page's row; nothing is shuffled.
    A page whose key occurs again is a page of its own.
    """
    body = F.regexp_replace(col(html), COMMENT, "")
    body = F.regexp_replace(body, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    tags = "|".join(_TAGS)
    p = pages.select(col(key).alias(key), col(url).alias("__url"), body.alias("__body"))
    p = p.select(
        key,
        "__url",
        F.regexp_extract_all("__body", F.lit(r"(?is)<base\b[^>]*>"), F.lit(0)).alias("__bases"),
        F.regexp_extract_all("__body", F.lit(rf"(?is)<(?:{tags})\b[^>]*>"), F.lit(0)).alias("__tags"),
    )
    bases = F.transform("__bases", lambda b: trim(attribute(b, "href")))
    based = let(F.get(F.filter(bases, lambda b: b != ""), F.lit(0)), lambda b: U.normalize_url(b, F.col("__url")))
    links = let(F.coalesce(based, F.col("__url")), lambda base: _found_links(F.col("__tags"), base))
    if skip:
        links = let(links, lambda x: F.filter(x, lambda y: ~U.has_skipped_extension(y["link"], skip)))
    p = p.select(key, F.posexplode(links).alias("__i", "__x"))
    return p.select(
        key, F.col("__x.link").alias("link"), F.struct("__x.rank", "__x.pos").alias("link_no"), (F.col("__i") + 1).alias("urutan"))


def text_urls(text) -> Column:
    """Unique absolute URLs written in a text, in order, without closing punctuation."""
    found = F.regexp_extract_all(col(text), F.lit(r"""(?i)https?://[^\s<>"'()\[\]{}]+"""), F.lit(0))
    return F.array_distinct(
        F.filter(F.transform(found, lambda u: F.regexp_replace(u, "[.,;:]+$", "")), lambda u: u != "")
    )


# --- robots -------------------------------------------------------------------


def agent_tokens(user_agent: str) -> list[str]:
    lower = user_agent.strip().lower()
    tokens = [K.DEFAULT_ROBOTS_TOKEN]
    if lower:
        first = lower.split(" ")[0]
        tokens += [first, first.split("/")[0]]
    return list(dict.fromkeys(t for t in tokens if t))


def _agent_group(agent: Column, tokens: list[str]) -> Column:
    hit = F.lit(False)
    for t in tokens:
        hit = hit | agent.contains(t) | F.lit(t).contains(agent)
    named = (agent != "") & ~agent.contains("*") & hit
    return F.when(agent == "*", F.lit("star")).when(named, F.lit("specific")).otherwise(F.lit("-"))


def parse_robots(df: DataFrame, body: str, user_agent: str = "") -> DataFrame:
    """Add ``rules`` (array<struct(allow, path, rule_no)>) and ``crawl_delay`` to each robots text.

    A text is at most half a megabyte, so it is folded inside its row.  The last agent line
    names the group; a group written for this agent wins when it has any rule.
    """
    tokens = agent_tokens(user_agent)
    lines = F.transform(
        F.split(F.regexp_replace(col(body), r"\r\n?", "\n"), "\n"),
        lambda x: trim(F.regexp_replace(x, "#.*$", "")),
    )
    lines = F.filter(lines, lambda x: x.contains(":"))
    pairs = F.transform(
        lines,
        lambda x: F.struct(
            F.lower(trim(F.regexp_extract(x, "^([^:]*):", 1))).alias("k"),
            trim(F.regexp_extract(x, "^[^:]*:(.*)$", 1)).alias("v"),
        ),
    )
    # the agent line that holds for a line is the last one up to it: one pass over marks, no state that grows
    df = df.withColumn("__p", pairs)
    df = df.withColumn("__agent", last_set(F.transform("__p", lambda p: p["k"] == "user-agent")))

    def entry(p, i):
        is_rule = p["k"].isin("allow", "disallow") & ~((p["k"] == "disallow") & (p["v"] == ""))
        number = p["v"].try_cast("double")
        is_delay = (p["k"] == "crawl-delay") & number.isNotNull()
        agent = F.get("__p", F.get("__agent", i))["v"]
        return F.struct(
            F.coalesce(_agent_group(F.lower(agent), tokens), F.lit("-")).alias("grp"),
            F.when(is_rule, p["k"] == "allow").alias("allow"),
            F.when(is_rule, p["v"]).alias("path"),
            F.when(is_delay, number).alias("delay"),
        )

    df = df.withColumn("__seen", F.transform("__p", entry))

    def rules_of(group):
        return F.filter("__seen", lambda r: (r["grp"] == group) & r["allow"].isNotNull())

    def delay_of(group):
        delays = F.filter("__seen", lambda r: (r["grp"] == group) & r["delay"].isNotNull())
        return F.try_element_at(delays, F.lit(-1))["delay"]

    own = F.size(rules_of("specific")) > 0
    df = df.withColumn("__own", own)
    chosen = F.when(F.col("__own"), rules_of("specific")).otherwise(rules_of("star"))
    df = df.withColumn("__chosen", chosen)
    rules = F.transform(
        "__chosen",
        lambda r, i: F.struct(
            r["allow"].alias("allow"), r["path"].alias("path"), (i + 1).alias("rule_no")
        ),
    )
    delay = F.when(
        F.col("__own"), F.coalesce(delay_of("specific"), delay_of("star"))
    ).otherwise(delay_of("star"))
    return df.withColumn("rules", rules).withColumn("crawl_delay", delay).drop(
        "__p", "__agent", "__seen", "__own", "__chosen"
    )


def ranked_rules(rules) -> Column:
    """Rules longest path first (in bytes), then file order: the first hit decides."""
    usable = F.filter(col(rules), lambda r: r["path"] != "")
    keyed = F.transform(
        usable,
        lambda r: F.struct(
            (-F.octet_length(r["path"])).alias("n"),
            r["rule_no"].alias("rule_no"),
            r["path"].alias("path"),
            r["allow"].alias("allow"),
        ),
    )
    return F.array_sort(keyed)


def robots_target(url) -> Column:
    p, q = U.path(url), U.query(url)
    return F.concat(
        F.when(p == "", F.lit("/")).otherwise(p),
        F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q)),
    )


def robots_allows(target, ranked) -> Column:
    """Longest matching prefix decides; no match allows."""
    hit = F.get(F.filter(col(ranked), lambda r: col(target).startswith(r["path"])), F.lit(0))
    return F.coalesce(hit["allow"], F.lit(True))


def effective_delay_ms(crawl_delay, configured_ms) -> Column:
    return F.greatest(
        col(configured_ms).cast("int"),
        F.coalesce(F.round(col(crawl_delay) * 1000).cast("int"), F.lit(0)),
    )


def check_robots(links: DataFrame, robots: DataFrame, host_key: str) -> DataFrame:
    """Add ``allowed`` to links.  ``robots`` has one row (host_key, rules) per host.

    An equi join on the host: the rules travel as one array per host, so a host with a third
    of all links meets one row, and adaptive execution splits its link partition.
    """
    r = robots.select(host_key, ranked_rules("rules").alias("__ranked"))
    j = links.join(r, host_key, "left")
    j = j.withColumn("__target", robots_target("link"))
    ok = F.coalesce(robots_allows("__target", "__ranked"), F.lit(True))
    return j.withColumn("allowed", ok).drop("__ranked", "__target")
