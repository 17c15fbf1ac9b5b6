"""Quality rules as a bitmask ledger; DataFrame functions only.

Each text is measured once and every rule is evaluated once.  The ledger keeps the measurements and one
``long`` of failure bits per row.  Policies are versioned sets of rules, that is masks: applying one, or
counting what each of its rules decides alone, reads the bits and never the texts again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import let
from docloom.llm.common import read, words
from docloom.llm.registry import query

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rules by bit, lowest first; each is true where a text fails.  New rules are added at the end only.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "capitals": "5 * n_upper > 2 * (n_upper + n_lower) AND n_upper + n_lower > 0",
    "exclamations": "2 * n_exclaim > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines AND n_dup_lines > 1",
    "word_length": "n_words > 0 AND (2 * word_chars < 5 * n_words OR word_chars > 12 * n_words)",
    "digits": "5 * n_digits > 3 * word_chars",
    "few_letters": "n_words > 0 AND 2 * (n_upper + n_lower) < word_chars",
}
#: Versioned policies: a text is kept if none of these rules fails.
POLICIES: dict[str, Sequence[str]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "capitals", "exclamations"),
    "v2": ("few_words", "repeated_windows", "symbols", "capitals", "exclamations", "repeated_lines", "word_length", "digits"),
}


def without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def count_of(c: Column, chars: str) -> Column:
    return (F.length(c) - F.length(without(c, chars))).cast("long")


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the array, first places included."""
    places = F.sequence(F.lit(1), F.size(w) - (window - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(w, i, window)))

    def covered(h: Column) -> Column:
        # windows in hash order; a window is repeated if a neighbour there has its hash
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(o: Column) -> Column:
            def same(p, k):
                before = F.coalesce(F.get(o, k - 1)["h"] == p["h"], F.lit(False))
                return before | F.coalesce(F.get(o, k + 1)["h"] == p["h"], F.lit(False))

            return F.array_sort(F.transform(F.filter(o, same), lambda p: p["i"]))

        def total(s: Column) -> Column:
            steps = F.transform(s, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(s, k + 1) - x, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(let(ordered, starts), total))

    return F.when(F.size(w) < window, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of each text; a null text is empty."""
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", t.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: without(line, BLANKS) != "")
    solid = without(F.col("text"), BLANKS)

    def by_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))

    def by_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))

    d = d.select(
        "doc_id", let(words(F.col("text")), by_words).alias("w"), let(lines, by_lines).alias("l"),
        F.length(solid).cast("long").alias("word_chars"), count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        count_of(F.col("text"), UPPER).alias("n_upper"), count_of(F.col("text"), UPPER.lower()).alias("n_lower"),
        count_of(F.col("text"), "!").alias("n_exclaim"), count_of(F.col("text"), "0123456789").alias("n_digits"),
    )
    return d.select(
        "doc_id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"),
        F.col("w.r").alias("n_repeat_words"), "n_upper", "n_lower", "n_exclaim", "n_digits",
    )


def mask_of(rules: Sequence[str]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of each row of ``docs(doc_id, text)`` and ``failed``: bit k is set where rule k fails.

    Null and empty texts have no words and fail ``few_words``.  Repeated rows and null ids are rows like
    any other; no rows give no rows; further columns are ignored.
    """
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured(docs).withColumn("failed", bits)


def apply_policy(marks: DataFrame, policy: str, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """Ledger rows with ``kept`` under a policy."""
    return marks.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask_of(policies[policy]))) == 0)


def ablation(marks: DataFrame, policy: str, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """``rule, failing, alone``: rows that fail a rule of the policy, and rows kept if that rule were left out.

    Rows are first counted by their bits under the mask, so there are at most 2^rules rows to work on.
    """
    mask = mask_of(policies[policy])
    counts = marks.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).count()
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r])).cast("long").alias("bit")) for r in policies[policy]])
    rows = counts.select("bits", "count", F.explode(each).alias("x"))
    return rows.groupBy(F.col("x.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("x.bit")) != 0, F.col("count")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("x.bit"), F.col("count")).otherwise(0)).alias("alone"),
    )


_SPACES = r"[\x20\x09-\x0D]+"
_ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
n_rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY 1),
m AS (SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(text, '{_SPACES}', '', 'g')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
  coalesce(n, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper, length(regexp_replace(text, '[^a-z]+', '', 'g')) AS n_lower,
  length(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclaim, length(regexp_replace(text, '[^0-9]+', '', 'g')) AS n_digits
  FROM w LEFT JOIN n_rep ON n_rep.doc_id = w.doc_id),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(f"({RULES[r]})" for r in POLICIES["v2"])}) AS kept FROM v
"""


@query("op5_quality_rules", _ORACLE)
def op5_quality_rules(spark, sf):
    marks = apply_policy(ledger(read(spark, sf, "documents")), "v2")
    base = F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES["base"]))) != 0
    return marks.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")
