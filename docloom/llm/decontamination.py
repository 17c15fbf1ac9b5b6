"""Benchmark decontamination by the q-gram lemma, counted in overlapping diagonal bands.

Texts and items are compared lower-cased with white space as one space.  An item of m characters is
leaked where a text holds it with at most ``e = rate * m`` edits.  Such a place shares at least
``m + 1 - q (e + 1)`` q-grams with the item, all on diagonals that differ by at most ``e``; so shared
q-grams are counted in bands of ``2 (e + 1)`` diagonals that overlap by half, bands that reach the bound are
retained, and their region is verified by a banded alignment.  q-grams that many items share are
left out of the index, and each one left out lowers that item's bound by one: no place is lost.

An item is also cut into windows of ``window`` words that overlap by half, and each window is searched in the same
way with its own budget.  A text that holds at least ``share`` of an item's windows, wherever they stand in it, has
leaked the item too: quoted parts, and what line dedup leaves of an item.

Items are the stated query set.  They are read in blocks of at most ``block_chars`` characters, each
block's index is broadcast, and each block takes one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import read
from docloom.llm.registry import query

_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class LeakOptions:
    """``q``: characters of a gram; ``rate``: edits per character of the item; ``common``: items that may
    share an indexed gram; ``block_chars``: characters of items and their windows in one broadcast; ``window``: words of
    a window (more where they have under two q-grams of characters); ``share``: of an item's windows that make a leak."""

    q: int = 10
    rate: float = 0.06
    common: int = 8
    block_chars: int = 4_000_000
    window: int = 8
    share: float = 1 / 3


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at each place, by doubling: O(log q) passes."""
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, have = x.astype(np.uint64) + np.uint64(1), 1
    parts: list[tuple[np.ndarray, int]] = []  # binary pieces of q
    need = q
    while True:
        if need & have:
            parts.append((h, have))
            need -= have
        if not need:
            break
        h = h[: len(h) - have] * np.uint64(pow(_BASE, have, 1 << 64)) + h[have:]
        have *= 2
    out, at = np.zeros(n, np.uint64), 0
    for h, size in reversed(parts):
        out = out * np.uint64(pow(_BASE, size, 1 << 64)) + h[at : at + n]
        at += size
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


class ItemIndex:
    """Grams of a block of items: sorted hashes, the items and places of each, each item's budget and bound."""

    def __init__(self, items: list[tuple[int, str]], o: LeakOptions):
        self.q, self.ids = o.q, [i for i, _ in items]
        self.texts = [t for _, t in items]
        size = np.array([len(t) for t in self.texts])
        # the bound must be positive: short items get a smaller budget, and none at 2 q
        self.edits = np.minimum((size * o.rate).astype(int), np.maximum((size + 1 - 1) // o.q - 1, 0))
        bound = size + 1 - o.q * (self.edits + 1)
        h = [gram_hashes(symbols(t), o.q) for t in self.texts]
        item = np.repeat(np.arange(len(h)), [len(x) for x in h])
        place = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, np.int64)
        grams = np.concatenate(h) if h else np.zeros(0, np.uint64)
        # items that share a gram: leave out the most shared of each item while its bound stays positive
        distinct = np.unique(np.stack([grams, item.astype(np.uint64)], 1), axis=0)[:, 0] if len(grams) else grams
        values, counts = np.unique(distinct, return_counts=True)
        shared = counts[np.searchsorted(values, grams)] if len(grams) else np.zeros(0, int)
        order = np.lexsort((-shared, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        drop = np.zeros(len(grams), bool)
        drop[order] = (shared[order] > o.common) & (rank < bound[item[order]] - 1)
        self.bound = bound - np.bincount(item[drop], minlength=len(bound))
        keep = np.flatnonzero(~drop)
        keep = keep[np.argsort(grams[keep], kind="stable")]
        self.item, self.place = item[keep].astype(np.int32), place[keep].astype(np.int32)
        self.grams, self.first = np.unique(grams[keep], return_index=True)
        self.first = np.append(self.first, len(keep))
        self.mask = np.zeros(1 << 22, bool)
        self.mask[(self.grams >> np.uint64(42)).astype(np.int64)] = True

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """``(text number, item number, edits, end)`` of each leaked item of each text: fewest edits, first end."""
        q = self.q
        gap = np.array([0xFFFFFFFF], np.uint32)  # no character: grams across texts match nothing
        runs = [symbols(t) for t in texts]
        starts = np.cumsum([0] + [len(r) + 1 for r in runs])[:-1]
        x = np.concatenate([y for r in runs for y in (r, gap)]) if runs else gap
        h = gram_hashes(x, q)
        at = np.flatnonzero(self.mask[(h >> np.uint64(42)).astype(np.int64)])
        g = np.searchsorted(self.grams, h[at])
        ok = g < len(self.grams)
        at, g = at[ok], g[ok]
        ok = self.grams[g] == h[at]
        at, g = at[ok], g[ok]
        if not len(at):
            return []
        n = self.first[g + 1] - self.first[g]
        row = np.repeat(self.first[g] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, place, at = self.item[row], self.place[row].astype(np.int64), np.repeat(at, n)
        doc = np.searchsorted(starts, at, side="right") - 1
        # fewer shared grams in the whole text than the bound: no band can reach it
        pair = doc * len(self.ids) + item
        u, inv, c = np.unique(pair, return_inverse=True, return_counts=True)
        enough = (c >= self.bound[u % len(self.ids)])[inv]
        pair, place, diagonal = pair[enough], place[enough], (at - starts[doc])[enough] - place[enough]
        width = self.edits[pair % len(self.ids)] + 1
        band = diagonal // width
        pair, place, width = np.tile(pair, 2), np.tile(place, 2), np.tile(width, 2)
        band = np.concatenate([band, band - 1])
        if not len(pair):
            return []
        # distinct item places in each band
        order = np.lexsort((place, band, pair))
        pair, band, place, width = pair[order], band[order], place[order], width[order]
        new = np.append(True, (pair[1:] != pair[:-1]) | (band[1:] != band[:-1]))
        fresh = new | np.append(True, place[1:] != place[:-1])
        heads = np.flatnonzero(new)
        count = np.add.reduceat(fresh.astype(np.int64), heads)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for i in heads[count >= self.bound[pair[heads] % len(self.ids)]].tolist():
            d, k = divmod(int(pair[i]), len(self.ids))
            found = self.verify(texts[d], k, int(band[i] * width[i]), 2 * int(width[i]))
            if found and found < best.get((d, k), (1 << 30, 0)):
                best[d, k] = found
        return [(d, k, e, end) for (d, k), (e, end) in sorted(best.items())]

    def verify(self, text: str, k: int, low: int, width: int) -> tuple[int, int] | None:
        """Fewest edits of item k against a part of the text that starts on diagonals low to low + width."""
        item, e = self.texts[k], int(self.edits[k])
        start = max(0, low - e)
        region = text[start : max(0, low + width + len(item) + e)]
        there = region.find(item)
        if there >= 0:
            return 0, start + there + len(item)
        found = banded(symbols(item), symbols(region), low - e - start, width + 2 * e + 1) if e else None
        return (found[0], start + found[1]) if found and found[0] <= e else None


def banded(item: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int] | None:
    """Fewest edits of the whole item against any part of the text that keeps to diagonals low .. low + width - 1.

    Row by row over the item; a row holds one cell for each diagonal.
    """
    far = 1 << 20
    d = np.arange(width)
    j = d + low  # column of each diagonal in row 0
    row = np.where((j >= 0) & (j <= len(text)), 0, far)
    padded = np.concatenate([text, np.full(1, 0xFFFFFFFF, np.uint32)])
    for i in range(1, len(item) + 1):
        j = d + low + i
        inside = (j >= 1) & (j <= len(text))
        cost = padded[np.where(inside, j - 1, len(text))] != item[i - 1]
        new = np.minimum(row + cost, np.append(row[1:], far) + 1)
        new = np.where(inside | (j == 0), new, far)
        new = np.minimum.accumulate(new - d) + d
        row = np.where(inside | (j == 0), new, far)
    best = int(row.min())
    return None if best >= far else (best, int((d + low + len(item))[np.argmin(row)]))


def windows_of(text: str, o: LeakOptions) -> list[str]:
    """Distinct windows of a normal text, from its first word to its last; none where one window would hold it all."""
    words = text.split(" ")
    out: dict[str, None] = {}
    for i in range(0, len(words), max(1, o.window // 2)):
        j = i + o.window
        while j < len(words) and len(" ".join(words[i:j])) < 2 * o.q:
            j += 1
        i = min(i, max(0, len(words) - o.window))  # the last one ends with the text
        while i and len(" ".join(words[i:j])) < 2 * o.q:
            i -= 1
        out[" ".join(words[i:j])] = None
        if j >= len(words):
            break
    return [w for w in out if w != text]


class LeakIndex:
    """A block of items, indexed whole and by windows."""

    def __init__(self, items: list[tuple[int, str]], o: LeakOptions):
        self.whole, self.share = ItemIndex(items, o), o.share
        self.ids = self.whole.ids
        cut = [windows_of(t, o) for _, t in items]
        self.size = [len(c) for c in cut]
        self.items_of: dict[str, list[int]] = {}
        for k, c in enumerate(cut):
            for w in c:
                self.items_of.setdefault(w, []).append(k)
        self.windows = ItemIndex(list(enumerate(self.items_of)), o) if self.items_of else None

    def leaks(self, texts: list[str]) -> list[tuple[int, int, int | None, int, float]]:
        """``(text number, item number, edits, end, held)``: whole items, and items by their share of windows (no edits)."""
        whole = [(d, k, e, end, 1.0) for d, k, e, end in self.whole.leaks(texts)]
        if self.windows is None:
            return whole
        found = {(d, k) for d, k, *_ in whole}
        held: dict[tuple[int, int], tuple[int, int]] = {}
        for d, w, _, end in self.windows.leaks(texts):
            for k in self.items_of[self.windows.texts[w]]:
                n, last = held.get((d, k), (0, 0))
                held[d, k] = n + 1, max(last, end)
        part = [
            (d, k, None, end, n / self.size[k]) for (d, k), (n, end) in held.items()
            if (d, k) not in found and n >= self.share * self.size[k] - 1e-9
        ]
        return sorted(whole + part, key=lambda x: x[:2])


def item_blocks(benchmark: DataFrame, o: LeakOptions) -> Iterator[LeakIndex]:
    block: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        t = normal(r[1])
        if len(t) < 2 * o.q:
            continue
        if block and size + 3 * len(t) > o.block_chars:
            yield LeakIndex(block, o)
            block, size = [], 0
        block.append((r[0], t))
        size += 3 * len(t)  # windows hold each character twice
    if block:
        yield LeakIndex(block, o)


ROWS = 256  # rows whose texts are Python objects at a time; bounds a task's memory, not a result


def _runs(texts: list[str | None], limit: int = 1 << 18) -> Iterator[list[str]]:
    """Normal texts in runs of about ``limit`` characters."""
    run: list[str] = []
    size = 0
    for t in texts:
        run.append(normal(t))
        size += len(run[-1])
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            out = []
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                ids, base = part.column(0).to_pylist(), 0
                for texts in _runs(part.column(1).to_pylist()):
                    out += [(ids[base + d], index.ids[k], e, end, held) for d, k, e, end, held in index.leaks(texts)]
                    base += len(texts)
            columns = list(zip(*out)) or [[]] * 5
            arrays = [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "edits", "end_at", "held"])

    return run


def _drop(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                keep, base = np.ones(part.num_rows, bool), 0
                for texts in _runs(part.column(text_at).to_pylist()):
                    for d, *_ in index.leaks(texts):
                        keep[base + d] = False
                    base += len(texts)
                yield part.filter(pa.array(keep))

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, options: LeakOptions = LeakOptions()) -> DataFrame:
    """``doc_id, item_id, edits, end_at, held``: a row for each item in each row of ``docs`` that holds it or enough of it.

    ``edits``: the fewest, null where only windows were found; ``end_at``: where that place, or the last window, ends in
    the lower-cased, single-spaced text; ``held``: 1 for a whole item, else the share of its windows.  Null
    and empty texts hold nothing.  Items under two q-grams of characters (null ones too) are not
    searched: they would fit everywhere.  Repeated items and repeated rows are found each for itself; a
    null id stays null.  Further columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, edits long, end_at long, held double"
    out = spark.createDataFrame([], schema)
    for index in item_blocks(benchmark, options):
        out = out.union(d.mapInArrow(_find(spark.sparkContext.broadcast(index)), schema))
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame, options: LeakOptions = LeakOptions()) -> DataFrame:
    """The rows of ``docs`` that hold no item and no ``share`` of an item's windows, all columns as they are."""
    spark = docs.sparkSession
    for index in item_blocks(benchmark, options):
        docs = docs.mapInArrow(_drop(spark.sparkContext.broadcast(index), docs.columns.index("text")), docs.schema)
    return docs


@query("op7_qgram_decontamination")
def op7_qgram_decontamination(spark, sf):
    return find_leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
