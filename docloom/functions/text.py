"""Text helpers as Column expressions (all run inside the JVM)."""

from __future__ import annotations

from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K

# the characters that trimming removes: space, tab, LF, CR, NUL, VT
TRIM_CHARS = " \t\n\r\0\x0b"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def trim(c) -> Column:
    return F.btrim(col(c), F.lit(TRIM_CHARS))


def rtrim(c) -> Column:
    return F.regexp_replace(col(c), r"[ \t\n\r\x00\x0B]+$", "")


def collapse(c) -> Column:
    """Runs of (Unicode) white space become one space; ends trimmed.  What is one space already is left alone."""
    return trim(F.regexp_replace(col(c), r"(?U)\s{2,}|[\s&&[^ ]]", " "))


def replace_where(c, pattern: str, replacement: str, *marks: str) -> Column:
    """``regexp_replace`` of texts that hold one of ``marks``; the pattern can match no other text."""

    def run(t):
        held = reduce(lambda x, y: x | y, (t.contains(m) for m in marks))
        return F.when(held, F.regexp_replace(t, pattern, replacement)).otherwise(t)

    return let(col(c), run)


def blank_to_null(c) -> Column:
    t = trim(c)
    return F.when(t != "", t)


def normalize_whitespace(c) -> Column:
    """CR/LF unified, blanks collapsed, at most one empty line, ends trimmed."""
    t = replace_where(c, r"\r\n?", "\n", "\r")
    t = replace_where(t, r"[ \t]{2,}|\t", " ", "  ", "\t")
    t = replace_where(t, r" \n", "\n", " \n")
    return trim(replace_where(t, r"\n{3,}", "\n\n", "\n\n\n"))


def one_line(c, max_length: int = 160) -> Column:
    def shorten(t):
        cut = F.concat(F.substring(t, 1, max_length - 3), F.lit("..."))
        return F.when(F.length(t) > max_length, cut).otherwise(t)

    return let(trim(F.regexp_replace(col(c), r"[ \t\n\x0B\f\r]+", " ")), shorten)


def slug(c, max_length: int = 60) -> Column:
    def shorten(t):
        t = F.when(t == "", F.lit("halaman")).otherwise(t)
        return F.when(
            F.length(t) > max_length, F.btrim(F.substring(t, 1, max_length), F.lit("-"))
        ).otherwise(t)

    return let(
        F.btrim(F.regexp_replace(F.lower(trim(c)), r"[^a-z0-9]+", "-"), F.lit("-")), shorten
    )


def word_count(c) -> Column:
    """Words: a letter, then letters, apostrophes and hyphens; digits separate words."""
    letters = f"A-Za-z{K.WORD_LETTERS}"
    return F.regexp_count(col(c), F.lit(rf"[{letters}][{letters}'\-]*"))


def human_bytes(c) -> Column:
    n = col(c)
    return (
        F.when(n < 1024, F.concat(n.cast("string"), F.lit("B")))
        .when(n < 1024 * 1024, F.concat(_fixed(n / 1024, 1), F.lit("KB")))
        .otherwise(F.concat(_fixed(n / 1024 / 1024, 2), F.lit("MB")))
    )


def _fixed(c: Column, decimals: int) -> Column:
    return F.round(c, decimals).cast(f"decimal(28,{decimals})").cast("string")


def duration(c) -> Column:
    return F.concat(_fixed(col(c), 2), F.lit("s"))


def duration_minutes(c, decimals: int = 2) -> Column:
    return F.concat(_fixed(col(c) / 60, decimals), F.lit(" menit"))


def percent_reduced(before, after) -> Column:
    b, a = col(before), col(after)
    pct = F.round((1 - a / F.nullif(b, F.lit(0))) * 100).cast("int")
    return F.when((b <= 0) | (a >= b), F.lit("0%")).otherwise(
        F.concat(pct.cast("string"), F.lit("%"))
    )


def iso_utc(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


# every named reference of the HTML standard as one string: <1>name<2>characters<1>...
_NAMED = "\x01" + "\x01".join(
    f"{k[:-1]}\x02{v}" for k, v in sorted(html5.items()) if k.endswith(";")
) + "\x01"


def _named_reference(name: Column) -> Column:
    key = F.concat(F.lit("\x01"), name, F.lit("\x02"))
    at = F.instr(F.lit(_NAMED), key)
    value = F.substring_index(
        F.substr(F.lit(_NAMED), at + F.length(key), F.lit(8)), "\x01", 1
    )
    return F.when(at > 0, value)


def _decode_entity(e: Column) -> Column:
    return let(F.regexp_replace(e, "[&;]", ""), lambda name: _decode_name(e, name))


def _decode_name(e: Column, name: Column) -> Column:
    number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(
        F.substring(name, 2, 8)
    ).cast("int")
    utf32 = F.unhex(F.lpad(F.hex(number), 8, "0"))
    numeric = F.when(
        number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF), F.decode(utf32, "UTF-32")
    )
    common = (
        F.when(name == "amp", F.lit("&"))
        .when(name == "lt", F.lit("<"))
        .when(name == "gt", F.lit(">"))
        .when(name == "quot", F.lit('"'))
        .when(name == "apos", F.lit("'"))
        .when(name == "nbsp", F.lit(" "))
    )
    return F.coalesce(
        F.when(name.startswith("#"), numeric).otherwise(
            F.coalesce(common, _named_reference(name))
        ),
        e,
    )


def decode_entities(c) -> Column:
    """One left-to-right pass over character references, so ``&amp;lt;`` gives ``&lt;``."""
    t = col(c)
    parts = F.split(t, _ENTITY, -1)
    found = F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0))
    joined = F.array_join(
        F.zip_with(
            parts, found, lambda p, e: F.concat(p, F.coalesce(_decode_entity(e), F.lit("")))
        ),
        "",
    )
    return F.when(t.contains("&"), joined).otherwise(t)


def charset_from_content_type(c) -> Column:
    return F.nullif(
        F.regexp_extract(col(c), r'(?i)charset\s*=\s*"?([a-z0-9_\-]+)"?', 1), F.lit("")
    )
