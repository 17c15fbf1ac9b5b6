"""Repeated passages of whole texts, found in suffix arrays built by induced sorting.

A byte goes if a string of ``window`` bytes that covers it also starts anywhere else.

* Anchors: each window is known by the ``anchor``-byte string in it with the least hash (the leftmost
  one of equals).  Equal windows have equal anchors at the same place, so they can meet under the
  anchor's hash.  Neighbouring windows with one anchor travel as one piece of text.
* Only pieces whose anchor occurs more than once travel at all.  Equal pieces of a task are sent once,
  with their number.
* Shards: the pieces of an anchor lie in one shard of about ``shard_bytes``.  Its suffix array and the
  permuted common prefixes (see suffix_array.py) give the runs of suffixes that share ``window`` bytes;
  windows of a run with two places or more are repeated.
* An anchor with more than ``hot_bytes`` of sent pieces (a passage that very many texts share, in changing
  company) does not fit in one shard.  The windows of its distinct pieces are counted by their 128-bit hashes
  instead, which Spark adds up before it shuffles.

Texts travel compressed, once to be cut and once to be freed of the repeated spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import read, stored
from docloom.llm.registry import query
from docloom.llm.suffix_array import permuted_common_prefixes, suffix_array


@dataclass(frozen=True)
class RepeatOptions:
    """``window``: bytes of a repeated string; ``anchor``: bytes of an anchor; ``hot_bytes``: text of the
    sent pieces of an anchor up to which they meet in one shard; ``shard_bytes``: text of a shard;
    ``block_bytes``: text that is hashed at once."""

    window: int = 200
    anchor: int = 48
    hot_bytes: int = 2 << 20
    shard_bytes: int = 2 << 20
    block_bytes: int = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Anchors:
    """Anchors of the windows of texts that lie one after the other in a buffer."""

    def __init__(self, options: RepeatOptions):
        self.window, self.k = options.window, options.anchor
        n = 2 * options.block_bytes + options.window
        base = 0x9E3779B97F4A7C15
        self.power = np.cumprod(np.full(n, base, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
        self.symbol = _mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)

    def pieces(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """First window start, number of windows, anchor hash and places of it for each piece; ``ends`` cut the buffer into texts."""
        n, k, w = len(text), self.k, self.window - self.k + 1
        none = np.zeros(0, np.int64)
        left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
        start = np.flatnonzero(left >= self.window)
        if not len(start):
            return none, none, none.astype(np.uint64), none
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.symbol[text] * self.power[:n], out=sums[1:])
        gram = _mixed((sums[k:] - sums[:-k]) * self.inverse[: n - k + 1])
        # hash above, place below: the least is the least hash, then the leftmost; a sliding minimum by blocks of w
        packed = (gram & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(gram), dtype=np.uint64)
        size = -(-len(gram) // w) * w + w
        grid = np.full(size, np.iinfo(np.uint64).max)
        grid[: len(gram)] = packed
        grid = grid.reshape(-1, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[start], ahead[start + w - 1]) & np.uint64(0xFFFFFF)).astype(np.int64)
        hashes = gram[at]
        # equal anchors in a row are one piece: a run of one character is no row per window
        first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (start[1:] != start[:-1] + 1)))
        places = np.add.reduceat(np.append(True, at[1:] != at[:-1]).astype(np.int64), first)
        return start[first], np.diff(np.append(first, len(start))), hashes[first], places


TEXTS = "tn long, doc_ids array<long>, n_bytes long, copies long, text binary, starts array<int>, windows array<int>, anchors array<long>, places array<int>"


def _texts(options: RepeatOptions):
    """Documents to their distinct texts (equal ones of a block once), numbered, with their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        anchors, pack = Anchors(options), zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        ids: dict[bytes, list] = {}
        size = 0

        def cut() -> list[tuple]:
            """Pieces of all held texts; a long one is hashed part by part, parts overlap by a window less one byte."""
            rows: list[list] = [[] for _ in ids]
            held: list[tuple[int, int, bytes]] = []
            total = 0

            def hashed():
                ends = np.cumsum([len(x) for *_, x in held])
                start, windows, gram, places = anchors.pieces(np.frombuffer(b"".join(x for *_, x in held), np.uint8), ends)
                part = np.searchsorted(ends, start, side="right")
                bound = np.searchsorted(part, np.arange(len(held) + 1))
                for i, (t, offset, x) in enumerate(held):
                    a, b = bound[i], bound[i + 1]
                    if a < b:
                        rows[t].append((start[a:b] - (ends[i] - len(x)) + offset, windows[a:b], gram[a:b], places[a:b]))

            for t, text in enumerate(ids):
                for offset in range(0, max(1, len(text) - options.window + 1), options.block_bytes):
                    part = text[offset : offset + options.block_bytes + options.window - 1]
                    if held and total + len(part) > options.block_bytes + options.window:
                        hashed()
                        held, total = [], 0
                    held.append((t, offset, part))
                    total += len(part)
            if held:
                hashed()
            return [tuple(np.concatenate(x) for x in zip(*r)) if r else (np.zeros(0, np.int64),) * 4 for r in rows]

        def flush():
            nonlocal number
            found = cut()
            names = ["tn", "doc_ids", "n_bytes", "copies", "text", "starts", "windows", "anchors", "places"]
            of = [r[0].astype(np.int32) for r in found], [r[1].astype(np.int32) for r in found], [r[2].astype(np.uint64).view(np.int64) for r in found], [r[3].astype(np.int32) for r in found]
            columns = [
                pa.array(np.arange(number, number + len(ids))), pa.array(list(ids.values()), pa.list_(pa.int64())), pa.array([len(t) for t in ids], pa.int64()),
                pa.array([len(x) for x in ids.values()], pa.int64()), pa.array([pack.compress(t) for t in ids], pa.binary()),
                pa.array(of[0], pa.list_(pa.int32())), pa.array(of[1], pa.list_(pa.int32())), pa.array(of[2], pa.list_(pa.int64())), pa.array(of[3], pa.list_(pa.int32())),
            ]
            number += len(ids)
            return pa.RecordBatch.from_arrays(columns, names=names)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_buffer().to_pybytes()
                if text not in ids:
                    ids[text] = []
                    size += len(text)
                ids[text].append(doc_id)
                if size >= 4 * options.block_bytes or len(ids[text]) >= 4096:
                    yield flush()
                    ids, size = {}, 0
        if ids:
            yield flush()

    return run


PIECES = "tn long, start int, anchor long, p1 long, p2 long, n long, piece binary"


def _cut_pieces(options: RepeatOptions):
    """Texts with their candidate pieces, to a row for each place of a piece and one for each distinct piece of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        distinct: dict[bytes, list] = {}
        size = 0

        def places(tn, start, key):
            two = np.frombuffer(b"".join(key), np.int64).reshape(-1, 2)
            none = pa.nulls(len(tn), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(tn, pa.int64()), pa.array(start, pa.int32()), none, pa.array(two[:, 0]), pa.array(two[:, 1]), none, pa.nulls(len(tn), pa.binary())],
                                              names=["tn", "start", "anchor", "p1", "p2", "n", "piece"])

        def pieces():
            two = np.frombuffer(b"".join(distinct), np.int64).reshape(-1, 2)
            rows = list(distinct.values())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["tn", "start", "anchor", "p1", "p2", "n", "piece"])

        for b in batches:
            tns, starts, keys = [], [], []
            for tn, copies, packed, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                text = unpack.decompress(packed.as_buffer())
                found = found.values
                for start, windows, anchor in zip(*(found.field(i).to_pylist() for i in range(3))):
                    piece = text[start : start + windows - 1 + options.window]
                    key = xxhash.xxh3_128_digest(piece)
                    tns.append(tn)
                    starts.append(start)
                    keys.append(key)
                    if key in distinct:
                        distinct[key][1] += copies
                    else:
                        distinct[key] = [anchor, copies, piece]
                        size += len(piece)
                if len(tns) >= 1 << 16:
                    yield places(tns, starts, keys)
                    tns, starts, keys = [], [], []
                if size >= 16 << 20:
                    yield pieces()
                    distinct, size = {}, 0
            if tns:
                yield places(tns, starts, keys)
        if distinct:
            yield pieces()

    return run


MARKS = "p1 long, p2 long, marks array<int>"


def repeated_windows(pieces: list[bytes], number: np.ndarray, window: int) -> list[list[int]]:
    """For each piece the runs ``from, to`` of its window starts whose string occurs twice or more; ``number``: occurrences of each piece."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces])
    end = np.cumsum(size)
    piece = np.repeat(np.arange(len(pieces)), size)
    sa = suffix_array(text, 256)
    shared = permuted_common_prefixes(text, sa)[sa] >= window
    run = np.cumsum(~shared)
    whole = (end[piece] - np.arange(len(text)) >= window)[sa]
    times = np.bincount(run[whole], weights=number[piece[sa[whole]]], minlength=int(run[-1]) + 1)
    at = np.sort(sa[whole & (times[run] >= 2)])
    out: list[list[int]] = [[] for _ in pieces]
    if len(at):
        new = np.append(True, (at[1:] != at[:-1] + 1) | (piece[at[1:]] != piece[at[:-1]]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        of = piece[at[first]]
        begin = (end - size)[of]
        for p, a, b in zip(of.tolist(), (at[first] - begin).tolist(), (at[last] - begin + 1).tolist()):
            out[p] += (a, b)
    return out


def _shards(options: RepeatOptions):
    """Rows ``anchor, p1, p2, n, piece`` sorted by these, to the marks of each distinct piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int]] = []
        number: list[int] = []
        pieces: list[bytes] = []
        size, held = 0, None

        def flush():
            marks = repeated_windows(pieces, np.array(number), options.window)
            rows = [(k, m) for k, m in zip(keys, marks) if m]
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in rows], pa.int64()), pa.array([k[1] for k, _ in rows], pa.int64()), pa.array([m for _, m in rows], pa.list_(pa.int32()))], names=["p1", "p2", "marks"])

        for b in batches:
            for anchor, p1, p2, n, piece in zip(*(b.column(i).to_pylist() for i in range(4)), b.column(4)):
                if anchor != held and size >= options.shard_bytes:
                    yield flush()
                    keys, number, pieces, size = [], [], [], 0
                if anchor == held and keys and keys[-1] == (p1, p2):
                    number[-1] += n
                else:
                    keys.append((p1, p2))
                    number.append(n)
                    pieces.append(piece.as_buffer().to_pybytes())
                    size += len(pieces[-1])
                held = anchor
        if keys:
            yield flush()

    return run


def _window_hashes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                p1, p2, n, at, keys = [], [], [], [], []
                for x, y, m, piece in zip(*(part.column(i).to_pylist() for i in range(4))):
                    for i in range(len(piece) - window + 1):
                        keys.append(xxhash.xxh3_128_digest(piece[i : i + window]))
                        at.append(i)
                        p1.append(x)
                        p2.append(y)
                        n.append(m)
                two = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int64())], names=["w1", "w2", "p1", "p2", "at", "n"])

    return run


def _hot_marks(pieces: DataFrame, options: RepeatOptions) -> DataFrame:
    """Marks of the pieces of anchors that no single shard may hold, by counting their windows."""
    distinct = pieces.groupBy("p1", "p2").agg(F.sum("n").alias("n"), F.max("piece").alias("piece")).select("p1", "p2", "n", "piece")
    windows = stored(distinct.mapInArrow(_window_hashes(options.window), "w1 long, w2 long, p1 long, p2 long, at int, n long"), "repeats-windows")
    twice = windows.groupBy("w1", "w2").agg(F.sum("n").alias("n")).filter("n > 1").select("w1", "w2")
    at = windows.join(twice, ["w1", "w2"]).groupBy("p1", "p2").agg(F.collect_list("at").alias("at"))
    return at.select("p1", "p2", F.flatten(F.transform("at", lambda x: F.array(x, x + 1))).alias("marks"))


def removed_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal spans in order; spans that touch are one."""
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(stop[by])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


def _freed(window: int):
    """Texts and the marks of their pieces, to a row for each document with its spans and what is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def emit(rows):
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

        rows, size = [], 0
        for b in batches:
            for doc_ids, packed, marks in zip(b.column(0), b.column(1), b.column(2).to_pylist()):
                text = unpack.decompress(packed.as_buffer())
                spans, kept = [], text
                if marks:
                    offset = np.repeat([m["start"] for m in marks], [len(m["marks"]) // 2 for m in marks])
                    pair = np.concatenate([np.array(m["marks"]) for m in marks]).reshape(-1, 2)
                    a, z = removed_spans(offset + pair[:, 0], offset + pair[:, 1] - 1 + window)
                    spans = np.column_stack([a, z]).tolist()
                    edges = [0, *(x for s in spans for x in s), len(text)]
                    kept = b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                for d in doc_ids.as_py():
                    rows.append((d, len(text), spans, kept))
                    size += len(kept)
                    if size >= 8 << 20:
                        yield emit(rows)
                        rows, size = [], 0
        if rows:
            yield emit(rows)

    return run


def without_repeats(docs: DataFrame, options: RepeatOptions = RepeatOptions()) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for each row of ``docs(doc_id, text)``.

    ``spans``: removed byte ranges ``[from, to)``, maximal and in order; ``kept``: the other bytes of the
    UTF-8 text (they may end inside a character).  Null text is empty and keeps nothing; texts shorter than
    a window lose nothing.  Rows of equal text lose all windows, repeated and null ids are rows like any other.
    No rows give no rows; further columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = stored(d.mapInArrow(_texts(options), TEXTS), "repeats-texts")
    rows = texts.select("tn", "copies", F.explode(F.arrays_zip("starts", "windows", "anchors", "places")).alias("x"))
    rows = rows.select("tn", (F.col("copies") * F.col("x.places")).alias("times"), "x.starts", "x.windows", F.col("x.anchors").alias("anchor"))
    twice = rows.groupBy("anchor").agg(F.sum("times").alias("c")).filter("c > 1").select("anchor")
    found = rows.drop("times").join(twice, "anchor").groupBy("tn").agg(F.collect_list(F.struct("starts", "windows", "anchor")).alias("found"))
    cut = texts.select("tn", "copies", "text").join(found, "tn").select("tn", "copies", "text", "found")
    table = stored(cut.mapInArrow(_cut_pieces(options), PIECES), "repeats-pieces")
    pieces = table.filter("piece is not null").select("anchor", "p1", "p2", "n", "piece")
    hot = stored(pieces.groupBy("anchor").agg(F.sum(F.length("piece")).alias("size")).filter(F.col("size") > options.hot_bytes).select("anchor"), "repeats-hot")
    some_hot = not hot.isEmpty()
    cool = pieces.join(hot, "anchor", "left_anti") if some_hot else pieces
    cool = cool.repartition("anchor").sortWithinPartitions("anchor", "p1", "p2")
    marks = cool.mapInArrow(_shards(options), MARKS)
    if some_hot:
        marks = marks.unionByName(_hot_marks(pieces.join(hot, "anchor", "left_semi"), options))
    marks = stored(marks, "repeats-marks")
    places = table.filter("piece is null").select("tn", "start", "p1", "p2")
    of_text = places.join(marks, ["p1", "p2"]).groupBy("tn").agg(F.collect_list(F.struct("start", "marks")).alias("marks"))
    freed = texts.select("tn", "doc_ids", "text").join(of_text, "tn", "left").select("doc_ids", "text", "marks")
    return freed.mapInArrow(_freed(options.window), "doc_id long, n_bytes long, spans array<array<long>>, kept binary")


@query("op13_substring_dedup")
def op13_substring_dedup(spark, sf):
    found = without_repeats(read(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
