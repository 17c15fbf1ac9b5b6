"""Queries over exact and near duplicates; ``source`` is the site, ``doc_id`` the arrival order."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.operators import dedupe as D
from docloom.plans import sqltext as S
from docloom.plans.derived import documents
from docloom.plans.registry import query


@query(
    "exact_dup_first",
    """SELECT source, sha1(text) AS fingerprint, min(doc_id) AS first_seq, count(*) AS copies
    FROM documents GROUP BY 1, 2""",
)
def exact_dup_first(spark, sf):
    return D.first_copies(documents(spark, sf), "source", "doc_id", "text")


# first mention of every word keeps its place
def tokens_sql(limit):
    return rf"""
w AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(
  lower({S.rep('text', r'!?\[([^\]]*)\]\([^)]*\)', chr(92) + '1')}), '[^\p{{L}}\p{{N}}]+') AS l FROM documents)),
u AS (SELECT doc_id, x, min(i) AS i FROM w WHERE length(x) >= 3 GROUP BY 1, 2),
ranked AS MATERIALIZED (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM u),
tok AS MATERIALIZED (SELECT d.doc_id, source, text, coalesce(list(x ORDER BY rn) FILTER (rn <= {limit}), []) AS t
  FROM documents d LEFT JOIN ranked r ON r.doc_id = d.doc_id GROUP BY 1, 2, 3)
"""


_TOKENS = tokens_sql(K.FINGERPRINT_TOKENS)
NO_LIMIT = 1_000_000_000  # in the SQL only: beyond any text and any table


@query(
    "token_sets",
    f"WITH {_TOKENS} SELECT doc_id, len(t) AS jumlah, sha1(array_to_string(t, ' ')) AS sidik FROM tok",
)
def token_sets(spark, sf):
    d = documents(spark, sf).select("doc_id", D.content_tokens("text", K.FINGERPRINT_TOKENS).alias("t"))
    return d.select("doc_id", F.size("t").alias("jumlah"), F.sha1(F.array_join("t", " ")).alias("sidik"))


def greedy_sql(tokens, history):
    return f"""{tokens_sql(tokens)},
    s AS MATERIALIZED (SELECT *, sha1(text) AS fp, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM tok),
    pair AS MATERIALIZED (SELECT a.source, a.i AS ai, b.i AS bi, len(list_intersect(a.t, b.t)) AS k, len(a.t) AS na, len(b.t) AS nb
      FROM s a JOIN s b ON a.source = b.source AND a.i < b.i
        AND least(len(a.t), len(b.t)) >= {K.DUPLICATE_SIMILARITY} * greatest(len(a.t), len(b.t))),
    near AS MATERIALIZED (SELECT source, bi, list((ai, k::DOUBLE / (na + nb - k)) ORDER BY ai) AS c
      FROM pair WHERE k::DOUBLE / (na + nb - k) >= {K.DUPLICATE_SIMILARITY} GROUP BY 1, 2),
    cand AS MATERIALIZED (SELECT s.*, coalesce(c, []) AS c FROM s LEFT JOIN near n ON n.source = s.source AND n.bi = s.i),
    f AS (
      SELECT source, 0::BIGINT AS i, []::BIGINT[] AS acc, []::VARCHAR[] AS fps, []::BIGINT[] AS fpi, NULL::BIGINT AS doc_id,
        NULL::BOOLEAN AS accepted, NULL::VARCHAR AS jenis, NULL::BIGINT AS pertama, NULL::DOUBLE AS skor FROM s GROUP BY 1
      UNION ALL
      SELECT source, i, CASE WHEN jenis IS NULL AND nt > 0 THEN list_append(acc, i) ELSE acc END,
        CASE WHEN jenis IS NULL THEN list_append(fps, fp) ELSE fps END, CASE WHEN jenis IS NULL THEN list_append(fpi, i) ELSE fpi END,
        doc_id, jenis IS NULL, jenis, CASE jenis WHEN 'identik' THEN same WHEN 'mirip' THEN best[1] END,
        CASE jenis WHEN 'identik' THEN 1.0 WHEN 'mirip' THEN round(best[2], 4) END
      FROM (SELECT *, CASE WHEN same IS NOT NULL THEN 'identik' WHEN best[1] > 0 THEN 'mirip' END AS jenis FROM (
        SELECT f.source, c.i, f.acc, f.fps, f.fpi, c.doc_id, c.fp, len(c.t) AS nt,
          f.fpi[list_position(f.fps, c.fp)] AS same,
          list_reduce(list_filter(list_prepend((-1::BIGINT, 0::DOUBLE), c.c), lambda x: x[1] = -1 OR
            list_contains(f.acc[greatest(len(f.acc) - {history} + 1, 1):], x[1])),
            lambda p, q: CASE WHEN q[2] > p[2] THEN q ELSE p END) AS best
        FROM f JOIN cand c ON c.source = f.source AND c.i = f.i + 1)))
"""


GREEDY_SQL = greedy_sql(K.FINGERPRINT_TOKENS, K.FINGERPRINT_HISTORY)


@query(
    "near_dup_greedy",
    f"""WITH RECURSIVE {GREEDY_SQL}
    SELECT f.doc_id, f.accepted, f.jenis, p.doc_id AS pertama, f.skor FROM f LEFT JOIN s p ON p.source = f.source AND p.i = f.pertama
    WHERE f.doc_id IS NOT NULL""",
)
def near_dup_greedy(spark, sf):
    d = D.greedy_duplicates(documents(spark, sf), "source", "doc_id", "url", "text")
    return d.select(
        "doc_id", "accepted", "jenis",
        F.regexp_extract("url_pertama", "([0-9]+)$", 1).try_cast("long").alias("pertama"), "skor",
    )


@query(
    "near_dup_greedy_unlimited",
    f"""WITH RECURSIVE {greedy_sql(NO_LIMIT, NO_LIMIT)}
    SELECT f.doc_id, f.accepted, f.jenis, p.doc_id AS pertama, f.skor FROM f LEFT JOIN s p ON p.source = f.source AND p.i = f.pertama
    WHERE f.doc_id IS NOT NULL""",
)
def near_dup_greedy_unlimited(spark, sf):
    """Whole texts against all earlier documents of the site."""
    d = D.all_duplicates(documents(spark, sf), "source", "doc_id", "url", "text")
    return d.select(
        "doc_id", "accepted", "jenis",
        F.regexp_extract("url_pertama", "([0-9]+)$", 1).try_cast("long").alias("pertama"), "skor",
    )


@query(
    "token_sets_whole",
    f"WITH {tokens_sql(NO_LIMIT)} SELECT doc_id, len(t) AS jumlah, sha1(array_to_string(t, ' ')) AS sidik FROM tok",
)
def token_sets_whole(spark, sf):
    d = documents(spark, sf).select("doc_id", D.content_tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("jumlah"), F.sha1(F.array_join("t", " ")).alias("sidik"))


@query(
    "duplicate_counts",
    """SELECT source, count(*) AS dokumen, count(DISTINCT sha1(text)) AS unik, count(*) - count(DISTINCT sha1(text)) AS salinan
    FROM documents GROUP BY 1""",
)
def duplicate_counts(spark, sf):
    """Per-site totals from the per-text counts: the hot text is already one row per task."""
    d = D.first_copies(documents(spark, sf), "source", "doc_id", "text")
    return d.groupBy("source").agg(
        F.sum("copies").alias("dokumen"), F.count("*").alias("unik"),
        (F.sum("copies") - F.count("*")).alias("salinan"),
    )
