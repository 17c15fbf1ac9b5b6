"""Near-duplicate lines by a segment-partition edit join.

Two lines are linked if they are equal, or at most ``edits`` edits apart and both at least ``edit_chars``
long.  A line is cut into ``edits + 1`` segments; if a line at most ``edits`` longer is within
``edits`` edits, it holds one of the segments whole, near the same place.  So each line enters its
segments under (segment, its number, line length), and probes the substrings of the places that matter for
each shorter length (the multi-match-aware window).  Lines under one key are candidates; all are
verified by banded bit-parallel edit distance, many pairs at a time.

Scale: a key row is three integers; keys that a task sees often are dealt out by line at once, and keys
with more than ``chunk`` lines are split into pairs of chunks, so no group exceeds two chunks.
Texts are fetched only for lines that share a key.  A group sends the edges of a spanning forest and
the number of links of each line, never its pairs.  Lines are known by a 64-bit hash of their text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import components, read, stored
from docloom.llm.registry import query


@dataclass(frozen=True)
class LineOptions:
    """``edits``: between linked lines; ``min_chars``: shorter lines are no duplicates of anything;
    ``edit_chars``: shorter lines are linked only if equal; ``often``: lines of a key in one task that
    mark it as hot; ``chunk``: lines of a split key."""

    edits: int = 2
    min_chars: int = 10
    edit_chars: int = 24
    often: int = 256
    chunk: int = 1024


def lines_of(text: str | None) -> list[str]:
    """Lines as they are compared: without white space at both ends."""
    return [s.strip() for s in text.split("\n")] if text else []


def line_id(line: str) -> int:
    h = xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace"))
    return h - (1 << 64) if h >> 63 else h


def _lines(o: LineOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, rows, numbers, ids, sizes = [], [], [], [], []
            for doc, text, row in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                for i, line in enumerate(lines_of(text.as_py())):
                    if len(line) >= o.min_chars:
                        docs.append(doc)
                        rows.append(row)
                        numbers.append(i)
                        ids.append(line_id(line))
                        sizes.append(len(line))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(rows, pa.int64()), pa.array(numbers, pa.int32()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32())],
                names=["doc_id", "row", "line_no", "id", "n_chars"],
            )

    return run


_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def segment_keys(lines: list[str], tau: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(line number, key, segment number or -1 for a probe)`` of all segments and probes of lines that have ``tau + 1`` characters at least."""
    n = tau + 1
    size = np.array([len(s) for s in lines], np.int64)
    begin = np.cumsum(size) - size
    x = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    power, back = np.full(len(x) + 1, _BASE, np.uint64), np.full(len(x) + 1, _INVERSE, np.uint64)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x + np.uint64(1)) * power[:-1], out=total[1:])
    which, keys, index = [], [], []
    for delta in range(n):
        short = size - delta  # length of the indexed line
        for i in range(n):  # segment i: the last (short mod n) segments are one longer
            width = short // n
            extra = short % n
            start = i * width + np.maximum(0, i - (n - extra))
            long = width + (i >= n - extra)
            low = np.maximum(-i, delta - (tau - i))
            high = np.minimum(i, delta + (tau - i))
            for shift in range(low, high + 1):
                p = start + shift
                ok = np.flatnonzero((short >= n) & (p >= 0) & (p + long <= size))
                a = begin[ok] + p[ok]
                h = (total[a + long[ok]] - total[a]) * back[a]
                tag = (short[ok] * n + i).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + tag
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                which.append(ok)
                keys.append(h.view(np.int64))
                index.append(np.full(len(ok), i if delta == 0 and shift == 0 else -1, np.int32))
    return np.concatenate(which), np.concatenate(keys), np.concatenate(index)


def _key_rows(o: LineOptions):
    """Documents to key rows ``key, salt, id, index``; keys seen often in this task are salted by line."""

    def emit(lines: dict[int, str], seen: Counter):
        ids = np.array(list(lines), np.int64)
        which, key, index = segment_keys(list(lines.values()), o.edits)
        u, inv, c = np.unique(key, return_inverse=True, return_counts=True)
        many = np.flatnonzero(c > o.often // 8)
        for k, n in zip(u[many].tolist(), c[many].tolist()):
            seen[k] += n
        hot = np.array([k for k, n in seen.items() if n > o.often], np.int64)
        salted = np.isin(key, hot) if len(hot) else np.zeros(len(key), bool)
        salt = np.where(salted, 1 + (ids[which] % 1024), 0)
        # of each hot key its least and greatest line and an index row stay unsalted too, so that rows of
        # tasks that do not see the key often find a partner
        rows = [(key, salt, ids[which], index)]
        if salted.any():
            at = np.flatnonzero(salted)
            at = at[np.lexsort((ids[which[at]], key[at]))]
            new = np.append(True, key[at][1:] != key[at][:-1])
            by_index = np.flatnonzero(salted & (index >= 0))
            by_index = by_index[np.unique(key[by_index], return_index=True)[1]]
            extra = np.concatenate([at[new], at[np.append(new[1:], True)], by_index])
            rows.append((key[extra], np.zeros(len(extra), np.int64), ids[which][extra], index[extra]))
        for k, s, i, x in rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array(s.astype(np.int32)), pa.array(i), pa.array(x)], names=["key", "salt", "id", "index"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, str] = {}
        seen: Counter = Counter()
        size = 0
        for b in batches:
            for text in b.column(0):
                for line in lines_of(text.as_py()):
                    if len(line) >= o.edit_chars:
                        lines.setdefault(line_id(line), line)
                        size += len(line)
                if size > 1_000_000:
                    yield from emit(lines, seen)
                    lines, size = {}, 0
        if lines:
            yield from emit(lines, seen)

    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, salt) to the distinct rows of keys that hold two lines, one of them by index.

    A run of equal keys is held only until that is known; salted rows pass, their key is known to be shared.
    """
    def good(rows: np.ndarray) -> np.ndarray:
        """Mask over whole runs."""
        new = np.append(True, np.any(rows[1:, :2] != rows[:-1, :2], axis=1))
        heads = np.flatnonzero(new)
        size = np.diff(np.append(heads, len(rows)))
        lo, hi = np.minimum.reduceat(rows[:, 2], heads), np.maximum.reduceat(rows[:, 2], heads)
        index = np.maximum.reduceat(rows[:, 3], heads)
        return np.repeat(((lo != hi) & (index >= 0)) | (rows[heads, 1] > 0), size)

    def out(rows: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 2]), pa.array(rows[:, 3].astype(np.int32))], names=["key", "id", "index"])

    held, passing = np.zeros((0, 4), np.int64), None
    for b in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
        if not len(rows):
            continue
        if passing is not None:  # the run that was passing goes on
            same = (rows[:, 0] == passing[0]) & (rows[:, 1] == passing[1])
            n = len(rows) if same.all() else int(np.argmin(same))
            if n:
                yield out(rows[:n])
            rows = rows[n:]
            if not len(rows):
                continue
            passing = None
        rows = np.concatenate([held, rows])
        mask = good(rows)
        last = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
        if mask[-1]:
            passing, held = (rows[-1, 0], rows[-1, 1]), held[:0]
            yield out(rows[mask])
        else:
            yield out(rows[mask & ~last])
            held = rows[last]


def within(a: list[str], b: list[str], tau: int, cells: int = 2_000_000) -> np.ndarray:
    """Edit distance of each pair where it is at most ``tau``, else ``tau + 1``.

    What both lines share at their ends is cut off first; pairs of like length go together,
    ``cells`` symbols at a time.
    """
    left, right = [], []
    for s, t in zip(a, b):
        x, y = (np.frombuffer(v.encode("utf-32-le", "surrogatepass"), np.uint32) for v in (s, t))
        m = min(len(x), len(y))
        differ = np.flatnonzero(x[:m] != y[:m])
        head = int(differ[0]) if len(differ) else m
        m -= head
        differ = np.flatnonzero(x[len(x) - m :] != y[len(y) - m :])
        tail = m - 1 - int(differ[-1]) if len(differ) else m
        left.append(x[head : len(x) - tail])
        right.append(y[head : len(y) - tail])
    size = np.array([max(len(x), len(y)) for x, y in zip(left, right)], np.int64)
    order, result, i = np.argsort(size, kind="stable"), np.zeros(len(size), np.int64), 0
    while i < len(order):
        n = 1
        while i + n < len(order) and (n + 1) * (size[order[i + n]] + 1) <= cells:
            n += 1
        part = order[i : i + n]
        result[part] = _in_step([left[k] for k in part], [right[k] for k in part], tau)
        i += n
    return result


def _in_step(a: list[np.ndarray], b: list[np.ndarray], tau: int) -> np.ndarray:
    """Edit distances up to ``tau`` by a banded automaton, all pairs in step.

    One word of ``2 tau + 1`` bits for each number of errors: bit d is set if some alignment of the first j
    symbols of b ends on diagonal d of the band with that many errors.  All pairs step through j
    together; a pair without a set bit is dropped.
    """
    n, band = len(a), 2 * tau + 1
    la, lb = np.array([len(s) for s in a], np.int64), np.array([len(s) for s in b], np.int64)
    result = np.full(n, tau + 1)
    rows = np.flatnonzero(np.abs(la - lb) <= tau)
    if not len(rows):
        return result
    wide = int(max(la[rows].max(), lb[rows].max()))
    x = np.full((n, wide + band + tau), 0xFFFFFFFF, np.uint32)  # a from column tau on; two fillers that equal nothing
    y = np.full((n, wide + 1), 0xFFFFFFFE, np.uint32)
    for i in rows.tolist():
        x[i, tau : tau + la[i]] = a[i]
        y[i, : lb[i]] = b[i]
    weights = 1 << np.arange(band, dtype=np.int64)
    full = (1 << band) - 1
    state = [np.full(n, 1 << tau, np.int64)]
    for e in range(1, tau + 1):  # symbols of a skipped before the first of b
        state.append((state[-1] | state[-1] << 1) & full)
    for j in range(wide + 1):
        done = lb[rows] == j
        if done.any():
            at = rows[done]
            bit = 1 << (la[at] - j + tau)
            for e in range(tau, -1, -1):
                result[at] = np.where(state[e][at] & bit, e, result[at])
            rows = rows[~done]
        if not len(rows):
            break
        match = (x[rows, j : j + band] == y[rows, j][:, None]) @ weights
        below = None
        alive = np.zeros(len(rows), np.int64)
        for e in range(tau + 1):
            old = state[e][rows]
            new = old & match
            if e:
                new |= before | before >> 1 | below << 1
            new &= full
            before, below = old, new
            state[e][rows] = new
            alive |= new
        rows = rows[alive > 0]
    return result


def first_shared(a: str, b: str, tau: int) -> int:
    """Number of the first segment of b that a holds near its place; a is at least as long as b."""
    n = tau + 1
    delta, width, extra = len(a) - len(b), len(b) // n, len(b) % n
    for i in range(n):
        start = i * width + max(0, i - (n - extra))
        seg = b[start : start + width + (i >= n - extra)]
        for shift in range(max(-i, delta - (tau - i)), min(i, delta + (tau - i)) + 1):
            if start + shift >= 0 and a[start + shift : start + shift + len(seg)] == seg:
                return i
    return n


def _group_links(o: LineOptions):
    """Rows sorted by (key, x, y) to forest edges ``a, b`` and numbers of links ``a, n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        links: Counter = Counter()
        edges: list[tuple[int, int]] = []
        pairs: list[tuple] = []

        def find(i):
            while parent.setdefault(i, i) != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        def verify():
            d = within([p[0] for p in pairs], [p[1] for p in pairs], o.edits)
            for (s, t, a, b, segment, ia, ib), e in zip(pairs, d.tolist()):
                if e > o.edits:
                    continue
                ra, rb = find(a), find(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    edges.append((a, b))
                # each pair counts at one of its keys: the first segment of the shorter that the longer holds
                long, short, index = (s, t, ib) if (len(s), s) > (len(t), t) else (t, s, ia)
                if index >= 0 and first_shared(long, short, o.edits) == segment:
                    links[a] += 1
                    links[b] += 1
            pairs.clear()

        def out():
            e = list(zip(*edges)) or [[], []]
            k, v = list(links), list(links.values())
            batch = pa.RecordBatch.from_arrays(
                [pa.array([*e[0], *k], pa.int64()), pa.array([*e[1], *[None] * len(k)], pa.int64()), pa.array([*[None] * len(e[0]), *v], pa.int64())],
                names=["a", "b", "n"])
            edges.clear()
            links.clear()
            parent.clear()
            return batch

        def group(x: int, y: int, rows: list[tuple]):
            segment = max(r[1] for r in rows)
            order = sorted(rows, key=lambda r: len(r[3]))
            for i, (a, ia, ma, s) in enumerate(order):
                for b, ib, mb, t in order[i + 1 :]:
                    if len(t) - len(s) > o.edits:
                        break
                    if (ia < 0 and ib < 0) or a == b:
                        continue
                    # lines of one chunk meet in one of its chunk pairs only
                    if x != y and ma == mb and not (x == 0 and (y == ma or (ma == 0 and y == 1))):
                        continue
                    pairs.append((s, t, a, b, segment, ia, ib))
                    if len(pairs) >= 8192:
                        verify()

        now, rows = None, []
        for b in batches:
            for key, x, y, i, index, mine, text in zip(*(c.to_pylist() for c in b.columns)):
                if now != (key, x, y):
                    if rows:
                        group(now[1], now[2], rows)
                        if len(edges) + len(links) > 100_000:
                            verify()
                            yield out()
                    now, rows = (key, x, y), []
                rows.append((i, index, mine, text))
        if rows:
            group(now[1], now[2], rows)
        if pairs:
            verify()
        yield out()

    return run


FILTER_BITS = 24  # of the slot filter: 2 MB, whatever the input


def slot_filter(ids: DataFrame) -> np.ndarray:
    """Bits of the slots ``id mod 2^24`` that occur: a filter of fixed size in front of the join on ids.

    It only spares rows; where most slots are taken it lets everything pass.
    """
    slot = F.pmod(F.col("id"), F.lit(1 << FILTER_BITS)) + 1
    parts = ids.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for bucket, bits in parts.collect():
        at = (bucket - 1) * 4096
        out[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _texts(o: LineOptions, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in batches:
            found: dict[int, str] = {}
            for text in b.column(0):
                for line in lines_of(text.as_py()):
                    if len(line) >= o.edit_chars:
                        found.setdefault(line_id(line), line)
            ids = np.array(list(found), np.int64)
            slot = ids & ((1 << FILTER_BITS) - 1)
            hit = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            lines = list(found.values())
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array([lines[i] for i in hit], pa.string())], names=["of", "text"])

    return run


def edit_links(texts: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """``a, b, n`` over the distinct lines of ``texts(text)``: forest edges (n null) and links of a line (b null)."""
    o = options
    keys = texts.mapInArrow(_key_rows(o), "key long, salt int, id long, index int")
    keys = keys.repartition("key", "salt").sortWithinPartitions("key", "salt", "id")
    shared = keys.mapInArrow(_shared_keys, "key long, id long, index int").groupBy("key", "id").agg(F.max("index").alias("index"))
    shared = stored(shared, "line-keys")
    wanted = shared.select("id").distinct()
    bits = texts.sparkSession.sparkContext.broadcast(slot_filter(wanted))
    lines = texts.mapInArrow(_texts(o, bits), "of long, text string").join(wanted, F.col("of") == F.col("id"), "left_semi")
    lines = lines.groupBy("of").agg(F.first("text").alias("line"))
    large = shared.groupBy("key").count().filter(F.col("count") > o.chunk)
    large = large.select(F.col("key").alias("k"), F.ceil(F.col("count") / o.chunk).cast("int").alias("g"))
    rows = shared.join(large, F.col("key") == F.col("k"), "left").withColumn("mine", F.coalesce(F.pmod(F.xxhash64("id", F.lit(7)), F.col("g")), F.lit(0)).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda x: x != F.col("mine"))
    parts = F.when(F.col("g").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
        F.transform(others, lambda x: F.struct(F.least(x, F.col("mine")).alias("x"), F.greatest(x, F.col("mine")).alias("y"))))
    rows = rows.select("key", "id", "index", "mine", F.explode(parts).alias("p")).join(lines, F.col("id") == F.col("of"))
    rows = rows.select("key", "p.x", "p.y", "id", "index", "mine", "line")
    groups = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "id")
    return groups.mapInArrow(_group_links(o), "a long, b long, n long")


def near_lines(docs: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """``doc_id, row, line_no, n_chars, class_id, n_links, first``: a row for each line long enough to have duplicates.

    ``line_no`` counts from 0; ``class_id`` is the least id of the lines linked directly or by a chain;
    ``n_links`` the number of other line texts linked directly; ``first`` marks the line that stays: the
    one of the smallest document id and line number of its class.  Null and empty texts have no lines.  ``row`` is a hash
    of the text: rows of one id (or without one) with other texts are other documents, in the order of ``row``; rows equal in
    id and text share their fate.  Null ids come last.
    No rows give no rows; further columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = d.withColumn("row", F.xxhash64("text"))
    lines = stored(marked.mapInArrow(_lines(options), "doc_id long, row long, line_no int, id long, n_chars int"), "lines")
    found = stored(edit_links(d.select("text"), options), "line-links")
    roots = components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("n is not null").groupBy(F.col("a").alias("linked")).agg(F.sum("n").alias("n_links"))
    # least place of each distinct line, then of each class: combined before the shuffle
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "line_no")
    distinct = lines.groupBy("id").agg(F.min(place).alias("place"))
    distinct = distinct.join(roots, F.col("id") == F.col("node"), "left").join(counts, F.col("id") == F.col("linked"), "left")
    distinct = stored(distinct.select("id", "place", F.coalesce("root", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "line-classes")
    least = distinct.groupBy(F.col("class_id").alias("of_class")).agg(F.min("place").alias("least"))
    known = distinct.join(least, F.col("class_id") == F.col("of_class")).select(F.col("id").alias("of"), "class_id", "n_links", "least")
    first = place.eqNullSafe(F.col("least"))
    return lines.join(known, F.col("id") == F.col("of")).select("doc_id", "row", "line_no", "n_chars", "class_id", "n_links", first.alias("first"))


def drop_repeated_lines(docs: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """``docs`` with the lines that are not the first of their class taken out of ``text``; no row is dropped.

    A text whose lines all go becomes empty; texts that lose nothing stay as they are, null too.  A
    column ``n_chars`` follows the text.
    """
    gone = near_lines(docs, options).filter(~F.col("first"))
    gone = gone.groupBy(F.col("doc_id").alias("__gone_id"), F.col("row").alias("__gone_row")).agg(F.collect_set("line_no").alias("__gone"))
    d = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["__gone_row"]), "left")
    lines = F.split(F.col("text"), "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")), lambda i: F.get(lines, i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = d.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(docs.columns)


@query("op4_line_dedup")
def op4_line_dedup(spark, sf):
    return near_lines(read(spark, sf, "documents")).drop("row")
