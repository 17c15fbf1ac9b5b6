"""Markdown cleaning.  Every rule works inside one row, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import markdown as M
from docloom.functions.arrays import first_places
from docloom.functions.text import let, normalize_whitespace, rtrim, trim

COUNTERS = [
    "komentar", "gambar", "label_kosong", "baris_noise",
    "blok_navigasi", "blok_duplikat", "judul_kosong",
]


def split_blocks(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return let(F.btrim(text, F.lit("\n")), lambda t: F.when(t == "", none).otherwise(F.split(t, "\n{2,}")))


def flag_lines(text: Column) -> Column:
    """array<struct(line, noise)>; blank lines stay as block separators."""
    return F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(
            F.when(trim(x) == "", F.lit("")).otherwise(rtrim(x)).alias("line"),
            ((trim(x) != "") & M.is_noise_line(x)).alias("noise"),
        ),
    )


def drop_navigation_runs(blocks: Column) -> Column:
    """struct(kept, dropped): runs of link-only blocks of two lines or more, and labels, go."""
    rated = F.transform(
        blocks,
        lambda b: F.struct(
            b.alias("b"),
            M.block_kind(b).alias("k"),
            (F.regexp_count(b, F.lit("\n")) + 1).alias("n"),
        ),
    )
    def weighed(rs):
        def stays(x, i):
            # lines of the run around a block; every block has one at least, so few neighbours decide
            weight = x["n"]
            for side in (-1, 1):
                joined = F.lit(True)
                for k in range(1, K.NAV_RUN_MIN):
                    near = F.get(rs, i + side * k)
                    joined = joined & F.coalesce(near["k"] == "navigasi", F.lit(False))
                    weight = weight + F.when(joined, near["n"]).otherwise(0)
            return (x["k"] != "label") & ((x["k"] != "navigasi") | (weight < K.NAV_RUN_MIN))

        kept = F.transform(F.filter(rs, stays), lambda x: x["b"])
        return let(kept, lambda ks: F.struct(ks.alias("kept"), (F.size(rs) - F.size(ks)).alias("dropped")))

    return let(rated, weighed)


def first_of_each(blocks: Column) -> Column:
    """Blocks whose text (case and spacing ignored) was not seen before in the document."""
    keys = F.transform(blocks, lambda b: F.lower(F.regexp_replace(b, r"(?U)\s+", " ")))
    both = F.struct(blocks.alias("b"), keys.alias("k"))
    return let(both, lambda x: F.transform(first_places(x["k"]), lambda i: F.get(x["b"], i)))


def drop_empty_headings(blocks: Column) -> Column:
    """Heading blocks go when nothing, or a heading of the same or higher rank, follows."""
    rated = F.transform(
        blocks, lambda b: F.struct(b.alias("b"), M.heading_level(b).alias("h"))
    )

    def keep(rs):
        def stays(x, i):
            following = F.get(rs, i + 1)["h"]
            deeper = following.isNotNull() & ((following == 0) | (following > x["h"]))
            return (x["h"] == 0) | deeper

        return F.transform(F.filter(rs, stays), lambda x: x["b"])

    return let(rated, keep)


def with_clean_markdown(df: DataFrame, text: str, out: str = "bersih") -> DataFrame:
    """Add the cleaned markdown ``out`` and one counter column per rule.

    Staged projections: each intermediate text is computed once per row.
    """
    t = "__t"
    df = df.withColumn(t, F.regexp_replace(text, r"\r\n?", "\n"))
    for name, pattern, between in [
        ("komentar", r"(?s)<!--.*?-->", None),
        ("gambar", M.IMAGE, M.fix_link_targets),
        ("label_kosong", M.EMPTY_LINK, M.tidy_link_labels),
    ]:
        df = df.withColumn(name, F.regexp_count(t, F.lit(pattern)))
        df = df.withColumn(t, F.regexp_replace(t, pattern, ""))
        if between:
            df = df.withColumn(t, between(t))
    df = df.withColumn("__lines", flag_lines(F.col(t)))
    df = df.withColumn("baris_noise", F.size(F.filter("__lines", lambda x: x["noise"])))
    kept = F.transform(F.filter("__lines", lambda x: ~x["noise"]), lambda x: x["line"])
    df = df.withColumn("__blocks", split_blocks(F.array_join(kept, "\n")))
    df = df.withColumn("__nav", drop_navigation_runs(F.col("__blocks")))
    df = df.withColumn("blok_navigasi", F.col("__nav.dropped"))
    df = df.withColumn("__unik", first_of_each(F.col("__nav.kept")))
    df = df.withColumn("blok_duplikat", F.size("__nav.kept") - F.size("__unik"))
    df = df.withColumn("__isi", drop_empty_headings(F.col("__unik")))
    df = df.withColumn("judul_kosong", F.size("__unik") - F.size("__isi"))
    df = df.withColumn(out, normalize_whitespace(F.array_join("__isi", "\n\n")))
    return df.drop(t, "__lines", "__blocks", "__nav", "__unik", "__isi")


def with_boilerplate_dropped(df: DataFrame, text: str, out: str, count: str) -> DataFrame:
    """Only noise lines and the headings they empty: the fallback for very short results."""
    df = df.withColumn("__lines", flag_lines(normalize_whitespace(text)))
    kept = F.transform(F.filter("__lines", lambda x: ~x["noise"]), lambda x: x["line"])
    df = df.withColumn("__b", split_blocks(F.array_join(kept, "\n")))
    df = df.withColumn("__k", drop_empty_headings(F.col("__b")))
    noise = F.size(F.filter("__lines", lambda x: x["noise"]))
    df = df.withColumn(count, noise + F.size("__b") - F.size("__k"))
    df = df.withColumn(out, normalize_whitespace(F.array_join("__k", "\n\n")))
    return df.drop("__lines", "__b", "__k")


def cleaned_or_fallback(
    df: DataFrame, text: str, out: str, min_length: int = K.MIN_CHUNK_LENGTH
) -> DataFrame:
    """The text the later stages use: cleaned, or without boilerplate when too little is left."""
    df = with_clean_markdown(df, text, "__full")
    enough = F.length("__full") >= max(1, min_length)
    # only texts that need the fallback go through its rules
    df = df.withColumn("__short", F.when(enough, F.lit(None)).otherwise(F.col(text)))
    df = with_boilerplate_dropped(df, "__short", "__soft", "__n")
    return df.withColumn(out, F.when(enough, F.col("__full")).otherwise(F.col("__soft"))).drop(
        "__full", "__short", "__soft", "__n", *COUNTERS
    )
