"""Source divergence audit by sorting pointers to word starts.

A shard is a run of documents in an Arrow buffer.  Every word start is a pointer into that buffer; the
pointers are sorted by multikey quicksort, where a character is a chunk of eight bytes: a slice is split
in three by its pivot chunk, and only the middle part looks at the next chunk.  Pointers of equal words
end up side by side, so the runs of equal words give, in one pass, how often each (lang, source) group
uses a word and in how many of its documents.  Spark adds the runs of all shards.

The audit compares the word shares of each source with those of the other sources of its language
(part ``pair``) and names the words a source uses more than its language (part ``term``).

Scale: a shard sends one row for each of its (group, word) runs.  Words of a language are dealt out to
buckets of about ``bucket_rows`` counts, so no task holds a language; a bucket sends its partial sums for
each pair of sources and the rows that can still be among the first ``top`` of a source.  The pairs of
sources are the result itself.  Their number per bucket is bounded by ``tile`` sources on one side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.llm.common import read, stored
from docloom.llm.registry import query
from docloom.operators.skew import top_per_key

UNIT = 1_000_000_000  # word shares are counted in billionths


@dataclass(frozen=True)
class AuditOptions:
    """``min_docs``: documents of a language that hold a kept word; ``top``: words named for a source;
    ``smoothing``: added to each count; ``shard_bytes``: text of a shard; ``bucket_rows``: counts of a
    bucket; ``tile``: sources whose pairs one bucket handles."""

    min_docs: int = 3
    top: int = 200
    smoothing: int = 1
    shard_bytes: int = 8 << 20
    bucket_rows: int = 200_000
    tile: int = 128


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
SMALL = 1024  # slices up to this size are sorted at once, as quicksorts do


def word_pointers(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of each word of a buffer that holds documents between ``offsets``."""
    inside = _LETTER[text]
    before, after = np.zeros(len(text), bool), np.zeros(len(text), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(text))]
    before[cuts] = False
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - start
    return start, length, np.searchsorted(offsets, start, side="right") - 1


_KEEP = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(8)] + [(1 << 64) - 1], np.uint64)  # the first n bytes of a chunk


def chunks(text: np.ndarray, start: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """Bytes ``8 * depth`` to ``8 * depth + 8`` of words as big-endian numbers, zeros past the end; ``text`` has 8 spare bytes."""
    rest = np.minimum(np.maximum(length - 8 * depth, 0), 8)
    at = np.minimum(start + 8 * depth, len(text) - 8)
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)[at]
    return eight.view(">u8").ravel().astype(np.uint64) & _KEEP[rest]


def _sort_slice(text: np.ndarray, start: np.ndarray, length: np.ndarray, ids: np.ndarray, key: np.ndarray, depth: int) -> np.ndarray:
    """A small slice chunk by chunk: all groups that are still equal look at their next chunks together."""
    by = np.argsort(key, kind="stable")
    ids, key = ids[by], key[by]
    new = np.ones(len(ids), bool)
    new[1:] = key[1:] != key[:-1]
    while True:
        depth += 1
        group = np.cumsum(new) - 1
        # groups of two and more with a word that goes on
        first = np.flatnonzero(new)
        goes_on = (np.maximum.reduceat(length[ids], first) > 8 * depth) & (np.diff(first, append=len(ids)) > 1)
        at = np.flatnonzero(goes_on[group])
        if not len(at):
            return ids
        part = ids[at]
        key = chunks(text, start[part], length[part], depth)
        by = np.lexsort((key, group[at]))
        ids[at], key = part[by], key[by]
        new[at[1:]] |= (key[1:] != key[:-1]) & (group[at[1:]] == group[at[:-1]])


def sort_pointers(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Order of the words by their bytes; equal words stay in text order."""
    order = np.arange(len(start))
    first = chunks(text, start, length, 0)
    todo = [(0, len(order), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        ids = order[lo:hi]
        key = first[ids] if depth == 0 else chunks(text, start[ids], length[ids], depth)
        if hi - lo <= SMALL:
            order[lo:hi] = _sort_slice(text, start, length, ids, key, depth)
            continue
        pivot = np.sort(key[:: (hi - lo) // 9])[4]
        less, more = key < pivot, key > pivot
        same = ids[~(less | more)]
        left, right = ids[less], ids[more]
        order[lo:hi] = np.concatenate([left, same, right])
        if len(left) > 1:
            todo.append((lo, lo + len(left), depth))
        if len(right) > 1:
            todo.append((hi - len(right), hi, depth))
        if len(same) > 1 and length[same].max() > 8 * (depth + 1):
            todo.append((lo + len(left), hi - len(right), depth + 1))
    return order


def equal_runs(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Run number of each of the sorted words."""
    new = np.ones(len(start), bool)
    new[1:] = length[1:] != length[:-1]
    at, depth = np.flatnonzero(~new), 0
    while len(at):
        new[at] = chunks(text, start[at], length[at], depth) != chunks(text, start[at - 1], length[at - 1], depth)
        depth += 1
        at = at[~new[at] & (length[at] > 8 * depth)]
    return np.cumsum(new) - 1


def shard_runs(texts: list[bytes], groups: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a shard, and for each (word, group) run: word number, group, count, documents."""
    text = _LOWER[np.frombuffer(b"".join(texts) + bytes(8), np.uint8)]
    offsets = np.cumsum([0, *map(len, texts)])
    start, length, doc = word_pointers(text[:-8], offsets)
    none = np.zeros(0, np.int64)
    if not len(start):
        return [], none, none, none, none
    order = sort_pointers(text, start, length)
    start, length, doc = start[order], length[order], doc[order]
    run = equal_runs(text, start, length)
    # text order inside a run: a document's pointers are neighbours
    new_doc = np.ones(len(run), bool)
    new_doc[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    width = int(groups.max()) + 1
    cell = run * width + groups[doc]
    # runs are in order: only the groups inside a run are left to sort
    by = np.lexsort((groups[doc], run)) if width > 1 else np.arange(len(run))
    cell, new_doc = cell[by], new_doc[by]
    edge = np.flatnonzero(np.diff(cell, prepend=-1))
    first = np.flatnonzero(np.diff(run, prepend=-1))
    raw = text.tobytes()
    words = [raw[s : s + n] for s, n in zip(start[first].tolist(), length[first].tolist())]
    count = np.diff(edge, append=len(cell))
    docs = np.add.reduceat(new_doc.astype(np.int64), edge)
    cell = cell[edge]
    return words, cell // width, cell % width, count, docs


def _runs(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        groups: list[int] = []
        known: dict[tuple, int] = {}
        size = 0

        def flush():
            words, word, group, count, docs = shard_runs(texts, np.array(groups))
            names = list(known)
            lang, source = pa.array([k[0] for k in names], pa.string()), pa.array([k[1] for k in names], pa.string())
            columns = [lang.take(pa.array(group)), source.take(pa.array(group)), pa.array(words, pa.binary()).take(pa.array(word)), pa.array(count), pa.array(docs)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "c", "docs"])

        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            for key, text in zip(zip(langs, sources), b.column(2)):
                groups.append(known.setdefault(key, len(known)))
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size >= shard_bytes:
                    yield flush()
                    texts, groups, known, size = [], [], {}, 0
        if texts:
            yield flush()

    return run


def word_counts(docs: DataFrame, options: AuditOptions = AuditOptions()) -> DataFrame:
    """``lang, source, term, c, docs``: occurrences of each word in each group, and documents that hold it."""
    d = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    runs = d.mapInArrow(_runs(options.shard_bytes), "lang string, source string, term binary, c long, docs long")
    runs = runs.withColumn("term", F.col("term").cast("string"))
    return runs.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("docs").alias("docs"))


def shares(count: np.ndarray, total: np.ndarray, v: int, smoothing: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + smoothing) / (total + smoothing * v))``, by long division: no product passes 64 bits."""
    x, d = np.broadcast_arrays(count + smoothing, total + smoothing * v)
    out, r = x // d, x % d
    for _ in range(3):
        r = r * 1000
        out, r = out * 1000 + r // d, r % d
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _audit(options: AuditOptions):
    """Counts of a bucket of a language next to all its sources, to partial sums and first words."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, bucket, tile = (k.as_py() for k in key)
        names = right["source"].to_pylist()
        place = np.argsort(right["number"].to_numpy())
        names = [names[i] for i in place]
        total = right["n"].to_numpy()[place]
        s = len(names)
        mine = np.arange(tile * options.tile, min(s, (tile + 1) * options.tile))
        sums = np.zeros((len(mine), s), np.int64)
        found: list[tuple[int, str, int]] = []
        if left.num_rows:
            v, all_n = int(right["v"][0].as_py()), int(right["lang_n"][0].as_py())
            terms = left["term"].combine_chunks().dictionary_encode()
            index = {x: i for i, x in enumerate(names)}
            term = terms.indices.to_numpy()
            sources = left["source"].combine_chunks().dictionary_encode()
            source = np.array([index[x] for x in sources.dictionary.to_pylist()])[sources.indices.to_numpy()]
            c, of_lang = left["c"].to_numpy(), left["total"].to_numpy()
            words = terms.dictionary
            by = np.argsort(term, kind="stable")
            term, source, c, of_lang = term[by], source[by], c[by], of_lang[by]
            step = max(1, 2_000_000 // s)
            for lo in range(0, len(words), step):
                a, b = np.searchsorted(term, [lo, lo + step])
                count = np.zeros((min(step, len(words) - lo), s), np.int64)
                count[term[a:b] - lo, source[a:b]] = c[a:b]
                p = shares(count, total[None, :], v, options.smoothing)
                for i, m in enumerate(mine):
                    sums[i] += gap(p[:, m, None], p).sum(axis=0)
            inside = (source >= mine[0]) & (source <= mine[-1])
            term, source, c, of_lang = term[inside], source[inside], c[inside], of_lang[inside]
            p = shares(c, total[source], v, options.smoothing)
            q = shares(of_lang, np.int64(all_n), v, options.smoothing)
            value = np.where(p > q, gap(p, q), -1)
            for m in mine:
                at = np.flatnonzero((source == m) & (value >= 0))
                if len(at) > options.top:  # rows that tie with the last one stay
                    at = at[value[at] >= np.partition(value[at], len(at) - options.top)[len(at) - options.top]]
                found += [(m, words[int(t)].as_py(), x) for t, x in zip(term[at], value[at].tolist())]
        pairs = [(m, t) for m in mine for t in range(s) if t != m] if left.num_rows or bucket == 0 else []
        rows = len(pairs) + len(found)
        columns = [
            pa.array([lang] * rows, pa.string()), pa.array([names[m] for m, *_ in pairs] + [names[m] for m, *_ in found], pa.string()),
            pa.array(["pair"] * len(pairs) + ["term"] * len(found), pa.string()), pa.array([names[t] for _, t in pairs] + [w for _, w, _ in found], pa.string()),
            pa.array([int(sums[m - mine[0], t]) for m, t in pairs] + [x for *_, x in found], pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["lang", "source", "part", "item", "value"])

    return run


def audit_sources(docs: DataFrame, options: AuditOptions = AuditOptions()) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (lang, source) group of ``docs(text, lang, source)``.

    Null text, lang and source are empty strings.  A language keeps the words of at least ``min_docs`` of
    its documents (repeated rows count).  Part ``pair``: each other source of the language with the sum
    over all kept words of ``floor((p-q)^2/q)``, 0 where no word is kept.  Part ``term``: words with
    p > q of the language, the first ``top``.  Ties rank by item (byte order).  A group without words is
    compared like any other; the only source of a language has no pairs.  No rows give no rows; further
    columns are ignored.  All numbers are exact integers.
    """
    counts = stored(word_counts(docs, options), "audit-counts")
    per_term = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("c").alias("total"), F.collect_list(F.struct("source", "c")).alias("by_source"))
    kept = stored(per_term.filter(F.col("docs") >= options.min_docs).select("lang", "term", "total", "by_source"), "audit-kept")
    flat = kept.select("lang", "term", "total", F.explode("by_source").alias("x")).select("lang", "term", "total", "x.source", "x.c")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    of_group = flat.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    zero = {"n": 0, "v": 0, "lang_n": 0}
    groups = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(zero)
    by_lang = W.partitionBy("lang")
    groups = stored(
        groups.withColumn("number", F.row_number().over(by_lang.orderBy("source")) - 1).withColumn("sources", F.count("*").over(by_lang)), "audit-groups")
    entries, most = flat.count(), groups.agg(F.max("sources")).first()[0] or 0
    buckets, tiles = max(1, math.ceil(entries / options.bucket_rows)), max(1, math.ceil(most / options.tile))
    left = flat.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    left = left.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    of_tiles = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / options.tile).cast("int"))
    right = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).withColumn("tile", F.explode(of_tiles))
    keys = ["lang", "bucket", "tile"]
    if tiles > 1:  # a language with fewer sources has fewer tiles
        left = left.join(right.select(*keys).distinct(), keys, "left_semi")
    parts = stored(
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_audit(options), "lang string, source string, part string, item string, value long"), "audit-parts")
    order = [F.col("value").desc(), F.col("item")]
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(*order)))
    terms = top_per_key(parts.filter("part = 'term'"), ["lang", "source"], order, options.top).withColumnRenamed("rn", "rank")
    return pairs.unionByName(terms)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
l AS (SELECT g.lang, count(k.term) AS v, coalesce(sum(k.total), 0) AS n FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
g AS (SELECT a.lang, a.source, coalesce(sum(c.c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) a
      LEFT JOIN c ON c.lang = a.lang AND c.source = a.source GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + (1000000000 * (coalesce(c.c, 0) + 1)::HUGEINT) // (g.n + l.v)::HUGEINT AS p,
         1 + (1000000000 * (k.total + 1)::HUGEINT) // (l.n + l.v)::HUGEINT AS q
  FROM g JOIN l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
          LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", SQL)
def op11_source_divergence(spark, sf):
    return audit_sources(read(spark, sf, "documents"))
