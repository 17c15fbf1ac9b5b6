"""Near duplicates by SimHash: fingerprints compared in vertical bit planes.

Every pair of fingerprints within ``radius`` is found.  The 64 bits are cut into ``radius + 2``
blocks; a pair that differs in ``radius`` bits agrees on two whole blocks at least, so each fingerprint
enters one table for each pair of blocks, and only rows of a table with equal block bits are compared.
Equal fingerprints are one row before any of that, so copies cost nothing here.

Rows of one key are compared bit-sliced: 64 fingerprints lie in one machine word per plane, a
carry-save counter adds the differing bits of all planes for 64 pairs at once, and a word is left
as soon as all its pairs are over the radius.  A key with more than ``chunk`` rows is split: its
rows are dealt into chunks and each pair of chunks is a group of its own, so no group exceeds
two chunks.  A group sends the edges of a spanning forest, not all its pairs; classes are the
connected components of those edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import components, read, split_words, stored
from docloom.llm.registry import query


@dataclass(frozen=True)
class SimhashOptions:
    """``shingle``: words; ``seed``: of XXH64; ``radius``: differing bits; ``chunk``: rows of a split key."""

    shingle: int = 3
    seed: int = 42
    radius: int = 3
    chunk: int = 4096


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint: bit set where over half of the shingle hashes have it; 0 without words."""
    found = split_words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-1].tolist()]
    last = (ends - 1).tolist()[min(shingle, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, last)), np.uint64, len(last))
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):  # long texts in parts: 64 bytes for each shingle
        count += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(options: SimhashOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), options.shingle, options.seed) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, options: SimhashOptions = SimhashOptions()) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.mapInArrow(_fingerprints(options), "doc_id long, fp long")


def planes(fp: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: plane p, word w holds bit p of rows 64 w to 64 w + 63."""
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    width = -(-packed.shape[1] // 8) * 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, width - packed.shape[1])))).view(np.uint64)


def close_at_shift(p: np.ndarray, ok: np.ndarray, words: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Rows i with at most ``radius`` bits (rounded up to 2^k - 1) between i and i + shift.

    ``p``: planes with spare words behind; ``ok``: bit mask of the pairs asked for, for each of ``words``.
    """
    q, r = np.uint64(shift >> 6), np.uint64(shift & 63)
    at = words + int(q)
    sums = [np.zeros(len(words), np.uint64) for _ in range(max(1, int(radius).bit_length()))]
    over = ~ok
    for plane in range(64):
        other = p[plane, at] if r == 0 else (p[plane, at] >> r) | (p[plane, at + 1] << (np.uint64(64) - r))
        carry = p[plane, words] ^ other
        for s in sums:
            s ^= carry
            carry = carry & ~s
        over |= carry
        if plane % 8 == 7:
            live = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not live.any():
                return np.zeros(0, np.int64)
            if 2 * live.sum() < len(live):
                words, at, over, sums = words[live], at[live], over[live], [s[live] for s in sums]
    hit = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, b = np.nonzero(hit)
    return words[w] * 64 + b


def forest(fp: np.ndarray, remaining: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links inside groups; row i is compared with the next ``remaining[i]``."""
    n = len(fp)
    longest = int(remaining.max(initial=0))
    if not longest:
        return []
    p = planes(fp)
    w = p.shape[1]
    p = np.pad(p, ((0, 0), (0, (longest >> 6) + 2)))
    rest = np.pad(remaining, (0, w * 64 - n)).reshape(w, 64)
    most = rest.max(axis=1)
    parent = np.arange(n)
    label = parent.copy()
    edges = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for shift in range(1, longest + 1):
        live = np.flatnonzero(most >= shift)
        ok = np.packbits(rest[live] >= shift, axis=1, bitorder="little").view(np.uint64).ravel()
        i = close_at_shift(p, ok, live, shift, radius)
        i = i[np.bitwise_count(fp[i] ^ fp[i + shift]) <= radius]
        i = i[label[i] != label[i + shift]]
        for a in i.tolist():
            ra, rb = find(a), find(a + shift)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                edges.append((a, a + shift))
        if len(i):
            label = parent
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
    return edges


def _group_edges(radius: int):
    """Rows sorted by group to forest edges; a group may lie across batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush(rows: np.ndarray):
            new = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
            ends = np.append(np.flatnonzero(new) + 1, len(rows))
            sizes = np.diff(ends, prepend=0)
            remaining = np.repeat(ends, sizes) - 1 - np.arange(len(rows))
            many = np.repeat(sizes, sizes) > 1
            fp = np.ascontiguousarray(rows[many, 3]).view(np.uint64)
            e = np.array(forest(fp, remaining[many], radius), np.int64).reshape(-1, 2)
            fp = fp.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(fp[e[:, 0]]), pa.array(fp[e[:, 1]])], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]))
            size += b.num_rows
            if size >= 1 << 16:
                rows = np.concatenate(held)
                change = np.flatnonzero(np.any(rows[1:, :3] != rows[:-1, :3], axis=1))
                if len(change):
                    cut = change[-1] + 1
                    yield flush(rows[:cut])
                    rows = rows[cut:]
                held, size = [rows], len(rows)
        if size:
            yield flush(np.concatenate(held))

    return run


def _table_keys(fp: Column, radius: int) -> Column:
    """One key for each pair of bit blocks: the table's number above the bits of both blocks."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    block = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])]
    keys = []
    for t, (i, j) in enumerate(combinations(range(n), 2)):
        low = cuts[j + 1] - cuts[j]
        both = F.shiftleft(block[i], low).bitwiseOR(block[j])
        keys.append(both.bitwiseOR(F.lit(t << 40)))
    return F.array(*keys)


def link_classes(nodes: DataFrame, options: SimhashOptions = SimhashOptions()) -> DataFrame:
    """Distinct fingerprints ``fp`` to ``fp, root``: equal roots are linked, directly or by a chain."""
    c = options.chunk
    rows = nodes.select("fp", F.explode(_table_keys(F.col("fp"), options.radius)).alias("key"))
    large = rows.groupBy("key").count().filter(F.col("count") > c)
    large = large.select("key", F.ceil(F.col("count") / c).cast("int").alias("g"))
    rows = rows.join(large, "key", "left").withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("g")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda x: x != F.col("mine"))
    parts = F.when(F.col("g").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
        F.transform(others, lambda x: F.struct(F.least(x, F.col("mine")).alias("x"), F.greatest(x, F.col("mine")).alias("y"))))
    groups = rows.select("key", "fp", F.explode(parts).alias("p")).select("key", "p.x", "p.y", "fp")
    groups = groups.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "fp")
    edges = groups.mapInArrow(_group_edges(options.radius), "a long, b long")
    return nodes.join(components(edges), F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, options: SimhashOptions = SimhashOptions()) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs(doc_id, text)``, repeated rows included.

    ``component_id`` is the smallest id among all rows that are linked, directly or by a chain, by at
    most ``radius`` differing bits.  Texts without words (null and empty ones too) have
    fingerprint 0 and are linked like any other.  A null id is never the smallest; a class of null
    ids only has a null class.  No rows give no rows; further columns are ignored.
    """
    marks = stored(fingerprints(docs, options), "simhash")
    nodes = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = stored(link_classes(nodes.select("fp"), options).join(nodes.withColumnRenamed("fp", "of"), F.col("fp") == F.col("of")).drop("of"), "simhash-classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = classes.join(least, "root").select(F.col("fp").alias("of"), "component_id")
    return marks.join(of_fp, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, options: SimhashOptions = SimhashOptions()) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its class; all columns as they are.

    Rows that share an id stay or go together, of those that are equal in id and text one stays.
    """
    found = stored(near_duplicates(docs.select("doc_id", "text"), options), "simhash-kept")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("__first_id")).count()
    once, more = first.filter("count = 1").select("__first_id"), first.filter("count > 1").select("__first_id")
    same = docs["doc_id"].eqNullSafe(F.col("__first_id"))
    return docs.join(once, same, "left_semi").union(docs.join(more, same, "left_semi").dropDuplicates(["doc_id", "text"]))


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark, sf):
    found = near_duplicates(read(spark, sf, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")
