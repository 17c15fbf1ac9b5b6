"""Near-duplicate decision on a stream, with state that expires."""

from __future__ import annotations

import math
import os
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docloom import constants as K
from docloom.functions.ids import content_sha1
from docloom.functions.text import col
from docloom.operators.dedupe import content_tokens, first_words, may_be_similar, set_marks

OUT = "site string, seq long, url string, accepted boolean, jenis string, url_pertama string, skor double"

_SLOTS = 1 << 13  # counters of a site's words by hash; words that share one share its count
_FIRST = 256  # documents after which an order of words is worth replacing
_ROWS = 2000  # documents whose prefixes are worked out at once
_WORDS = 250_000  # words of such documents, about
_PAIRS = 500_000  # pairs of a document and one under the same word that are looked at at once
_RUN = 2_000_000  # entries of a sorted run up to which runs are merged
_KNOWN = 50_000  # texts and entries of the state that are remembered in a micro-batch
_NONE = np.zeros((0, 7), np.int64)

#: Session settings for a stream of ``near_duplicates``: rows reach a task a few at a time, texts of some megabytes.
SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


class _Spool:
    """The rows of one site in one micro-batch in a file of their own, read back in arrival order a few at a time."""

    def __init__(self, frames: Iterator[pd.DataFrame], folder: str):
        self.file, self.codec = tempfile.TemporaryFile(dir=folder), pa.Codec("zstd", 1)
        seqs, parts, end = [], [], 0
        self.counts = np.zeros(_SLOTS, np.int64)
        for f in frames:
            seqs.append(f.seq)
            part = np.zeros((len(f), 4), np.int64)  # where it begins, bytes of the texts packed and plain, number of words
            for i, d in enumerate(f.itertuples(index=False)):
                plain, h = pickle.dumps((d.url, d.fp, d.words)), np.asarray(d.h, np.int64)
                packed = self.codec.compress(plain, asbytes=True)
                self.file.write(packed)
                self.file.write(h.tobytes())
                np.add.at(self.counts, h % _SLOTS, 1)
                part[i] = end, len(packed), len(plain), len(h)
                end += len(packed) + 8 * len(h)
            parts.append(part)
        self.file.flush()
        seq = pd.concat(seqs, ignore_index=True).sort_values(kind="stable")
        self.seq, self.at = seq.to_numpy(), np.concatenate(parts)[seq.index.to_numpy()]
        self.sizes = self.at[:, 3]

    def texts(self, i: int) -> tuple[str, str, str]:
        """(url, fp, words) of the row at place ``i``."""
        begin, packed, plain, _ = self.at[i].tolist()
        return pickle.loads(self.codec.decompress(os.pread(self.file.fileno(), packed, begin), plain, asbytes=True))

    def hashes(self, i: int) -> np.ndarray:
        begin, packed, _, n = self.at[i].tolist()
        return np.frombuffer(os.pread(self.file.fileno(), 8 * n, begin + packed), np.int64)

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Places from, to: at most ``_ROWS`` rows, and ``_WORDS`` words if more than one row."""
        ends, at = np.cumsum(self.sizes), 0
        while at < len(ends):
            fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _WORDS, "right"))
            to = min(max(fit, at + 1), at + _ROWS, len(ends))
            yield at, to
            at = to

    def close(self) -> None:
        self.file.close()


class _Runs:
    """(word, place) entries in sorted runs, each a mapped file: neighbours of like size are merged, so there are few."""

    def __init__(self, folder: str):
        self.folder, self.runs = folder, []

    def _mapped(self, values: np.ndarray) -> np.ndarray:
        with tempfile.TemporaryFile(dir=self.folder) as f:
            values.tofile(f)
            f.flush()
            return np.memmap(f, values.dtype, "r", shape=values.shape)

    def add(self, words: np.ndarray, places: np.ndarray) -> None:
        """Places of later calls are larger, so a stable order by word keeps them in order."""
        if not len(words):
            return
        while self.runs and len(self.runs[-1][0]) <= 2 * len(words) and len(self.runs[-1][0]) + len(words) <= _RUN:
            w, p = self.runs.pop()
            words, places = np.concatenate([w, words]), np.concatenate([p, places])
        order = np.argsort(words, kind="stable")
        self.runs.append((self._mapped(words[order]), self._mapped(places[order].astype(np.int32))))

    def under(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places, from, to) for each run: where in its places the rows under each word lie."""
        return [(p, np.searchsorted(w, words, "left"), np.searchsorted(w, words, "right")) for w, p in self.runs]

    def groups(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each word with its places; words of one part of their range are held at once."""
        parts = 1 + sum(len(w) for w, _ in self.runs) // _RUN
        step = 2**64 // parts + 1
        for k in range(parts):
            low, high = -(2**63) + k * step, min(-(2**63) + (k + 1) * step, 2**63) - 1
            cut = [(w, p, np.searchsorted(w, np.int64(low), "left"), np.searchsorted(w, np.int64(high), "right")) for w, p in self.runs]
            words = np.concatenate([np.zeros(0, np.int64), *(w[a:b] for w, _, a, b in cut)])
            places = np.concatenate([np.zeros(0, np.int32), *(p[a:b] for _, p, a, b in cut)])
            order = np.argsort(words, kind="stable")
            words, places = words[order], places[order]
            begins = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))) if len(words) else np.zeros(0, np.int64)
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(words)]):
                yield int(words[a]), np.sort(places[a:b])


def _fewest(n, sizes, threshold: float):
    """How many prefix words similar sets of these sizes have in common at least."""
    least = np.ceil((sizes + n) * (threshold / (1 + threshold)) - 1e-9)
    return np.maximum(least - np.ceil(threshold * np.maximum(sizes, n) - 1e-9) + 1, 1)


class NearDuplicates(StatefulProcessor):
    """State of one site: accepted texts by fingerprint, accepted documents by number, and a prefix index.

    The index files a document under its rarest words.  What is rare is fixed by an order, a copy of the
    counters of words; when a site has twice as many documents as its newest order knew, a new one is opened.  A document stays where it was
    filed, and a new one is looked up by its prefix in each order, of which there are as many as the site has doubled.
    An entry holds the document's size and mark, so only documents that can be similar are read.  A
    word's entries are written once in a micro-batch, and read once or twice.

    The rows of a micro-batch need not fit in memory: they lie in a file and are taken in arrival order, a block at a time; the prefixes
    of what was accepted lie in sorted files and reach the index at the end.  In memory are some numbers a document (size, mark, place).

    Every entry lives for ``ttl_ms`` after it was last written.  An expired text or document is forgotten as if
    it had never arrived; index entries may name expired documents, which are left out when met.  The newest order is
    written in each micro-batch, so that it outlives what is filed under it.
    """

    def __init__(self, threshold: float, ttl_ms: int):
        self.threshold, self.ttl_ms = threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.texts = handle.getMapState("texts", "fp string", "url string", self.ttl_ms)
        self.docs = handle.getMapState("docs", "number long", "url string, words string", self.ttl_ms)
        # entries: number, size, mark (4), time
        self.index = handle.getMapState("index", "start long, word long", "entries binary", self.ttl_ms)
        self.orders = handle.getMapState("orders", "start long", "counts binary, arrived long", self.ttl_ms)
        self.counts = handle.getValueState("counts", "counts binary, arrived long", self.ttl_ms)
        self.next = handle.getValueState("next", "number long")

    def _orders_for(self, words: np.ndarray, rows: int, number: int) -> list[tuple[int, np.ndarray]]:
        """(first number filed under it, counts) of each order, the newest last; ``words`` of ``rows`` documents are counted."""
        counts, arrived = words.copy(), rows
        if self.counts.exists():
            held, before = self.counts.get()
            counts += np.frombuffer(bytes(held), np.int64)
            arrived += before
        found = sorted(((k[0], bytes(v[0]), v[1]) for k, v in self.orders.iterator()), key=lambda o: o[0])
        if not found or arrived >= 2 * max(found[-1][2], _FIRST):
            found = [o for o in found if o[0] != number] + [(number, counts.tobytes(), arrived)]
        self.orders.updateValue((found[-1][0],), found[-1][1:])
        self.counts.update((counts.tobytes(), arrived))
        return [(start, np.frombuffer(c, np.int64)) for start, c, _ in found]

    def _entries(self, key: tuple[int, int], now: int) -> np.ndarray:
        held = self.index.getValue(key)
        if held is None:
            return _NONE
        found = np.frombuffer(bytes(held[0]), np.int64).reshape(-1, 7)
        return found[found[:, 6] + self.ttl_ms > now] if self.ttl_ms else found

    def _met(self, rows: np.ndarray, words: np.ndarray, runs: _Runs, at: int, sizes: np.ndarray, marks: np.ndarray) -> dict[int, np.ndarray]:
        """Places, in order, of the earlier documents that those of a block may be similar to, by row of the block.

        ``rows`` and ``words`` are the block's prefixes, ``runs`` those of documents accepted in earlier blocks.
        """
        own = _Runs(runs.folder)
        order = np.argsort(words, kind="stable")
        own.runs = [(words[order], rows[order] + at)]
        found, met = [*runs.under(words), *own.under(words)], {}
        total = np.zeros(int(rows[-1]) + 1 if len(rows) else 0, np.int64)
        for _, a, b in found:
            total += np.bincount(rows, b - a, len(total)).astype(np.int64)
        many = total > _PAIRS  # under common words: all earlier documents are fewer than these pairs, or nearly so
        for x in np.flatnonzero(many).tolist():
            met[x] = np.flatnonzero(may_be_similar(sizes[at + x], marks[at + x], sizes[: at + x], marks[: at + x], self.threshold))
        chunk = np.where(many, -1, np.cumsum(np.where(many, 0, total)) // _PAIRS)  # rows, in order, whose pairs are looked at at once
        for c in np.unique(chunk[~many]).tolist():
            some = np.flatnonzero(chunk[rows] == c)
            r, p = [], []
            for places, a, b in found:
                n = (b - a)[some]
                begin = np.repeat(a[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                who, where = np.repeat(rows[some], n), places[begin].astype(np.int64)
                earlier = where < who + at
                r.append(who[earlier])
                p.append(where[earlier])
            r, p = np.concatenate(r), np.concatenate(p)
            near = may_be_similar(sizes[r + at], marks[r + at], sizes[p], marks[p], self.threshold)
            pairs, shared = np.unique(r[near] * len(sizes) + p[near], return_counts=True)
            r, p = pairs // len(sizes), pairs % len(sizes)
            enough = shared >= _fewest(sizes[r + at], sizes[p], self.threshold)
            r, p = r[enough], p[enough]
            for x, places in zip(*(np.unique(r), np.split(p, np.flatnonzero(np.diff(r)) + 1))):
                met[int(x)] = places
        return met

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the rows of one site in one micro-batch, in arrival order; what grows with them lies in files
        with tempfile.TemporaryDirectory() as folder:
            spool = _Spool(rows, folder)
            try:
                yield from self._decided(key, spool, _Runs(folder), timerValues.getCurrentProcessingTimeInMs())
            finally:
                spool.close()

    def _decided(self, key, spool: _Spool, runs: _Runs, now: int) -> Iterator[pd.DataFrame]:
        start = self.next.get()[0] if self.next.exists() else 0
        orders = self._orders_for(spool.counts, len(spool.sizes), start)
        sizes, marks = spool.sizes, np.zeros((len(spool.sizes), 4), np.uint64)
        number = np.full(len(sizes), -1, np.int64)  # of the documents accepted in this micro-batch
        known: dict[str, str] = {}  # texts accepted in it, the last ones
        index: dict[tuple[int, int], np.ndarray] = {}  # entries of earlier ones, the last read
        accepted, forgot = start, False
        texts = lru_cache(256)(lambda place: (lambda t: (t[0], frozenset(t[2].split(" "))))(spool.texts(place)))

        def filed(k: tuple[int, int]) -> np.ndarray:
            if k not in index:
                if len(index) >= _KNOWN:
                    index.clear()
                index[k] = self._entries(k, now)
            return index[k]

        def similar(n: int, mark: np.ndarray, keys: list[tuple[int, int]], places: np.ndarray) -> Iterator[tuple[str, frozenset]]:
            old = np.concatenate([_NONE, *(filed(k) for k in keys)]) if start else _NONE
            if len(old):
                old = old[may_be_similar(n, mark, old[:, 1], old[:, 2:6].view(np.uint64), self.threshold)]
                found, first, shared = np.unique(old[:, 0], return_index=True, return_counts=True)
                for held in found[shared >= _fewest(n, old[first, 1], self.threshold)].tolist():
                    doc = self.docs.getValue((held,))
                    if doc is not None:
                        yield doc[0], frozenset(doc[1].split(" "))
            for place in places[number[places] >= 0].tolist():
                yield texts(place)

        for at, to in spool.blocks():
            h, n = np.concatenate([spool.hashes(i) for i in range(at, to)]), sizes[at:to]
            marks[at:to] = set_marks(h, n).view(np.uint64)
            row = np.repeat(np.arange(to - at), n)
            keys: list[list[tuple[int, int]]] = [[] for _ in range(to - at)]
            for first, counts in orders:
                used = first_words(h, n, counts[h % _SLOTS], self.threshold)
                if start:
                    for r, word in zip(row[used].tolist(), h[used].tolist()):
                        keys[r].append((first, word))
            prefix_rows, prefix = row[used], h[used]  # those of the newest order
            met = self._met(prefix_rows, prefix, runs, at, sizes, marks) if self.threshold < 1.0 else {}
            out, none = [], np.zeros(0, np.int64)
            for i in range(to - at):
                (url, fp, words), seq = spool.texts(at + i), spool.seq[at + i]
                kind, best, first, held = None, 0.0, None, known.get(fp)
                if held is None and (start or forgot) and fp is not None:
                    value = self.texts.getValue((fp,))
                    held = value[0] if value is not None else None
                if held is not None:
                    first, best = held, 1.0
                    kind = "identik" if first != url else None
                elif n[i] and self.threshold < 1.0 and (start or i in met):
                    tokens = set(words.split(" "))
                    for other_url, other in similar(int(n[i]), marks[at + i], keys[i], met.get(i, none)):
                        common = len(tokens & other)
                        score = common / (len(tokens) + len(other) - common)
                        if score > best:
                            best, first = score, other_url
                    kind = "mirip" if first is not None and best >= self.threshold else None
                if kind is None:
                    if held is None:
                        if fp is not None:
                            if len(known) >= _KNOWN:  # the state has them
                                known.clear()
                                forgot = True
                            known[fp] = url
                            self.texts.updateValue((fp,), (url,))
                        if n[i]:
                            self.docs.updateValue((accepted,), (url, words))
                            number[at + i] = accepted
                            accepted += 1
                    out.append((key[0], seq, url, True, None, None, None))
                else:
                    out.append((key[0], seq, url, False, kind, first, math.floor(best * 10000 + 0.5) / 10000))
            kept = number[prefix_rows + at] >= 0
            runs.add(prefix[kept], prefix_rows[kept] + at)
            yield pd.DataFrame(out, columns=["site", "seq", "url", "accepted", "jenis", "url_pertama", "skor"])
        for word, places in runs.groups():
            k = (orders[-1][0], word)
            fresh = np.column_stack((number[places], sizes[places], marks[places].view(np.int64), np.full(len(places), now)))
            self.index.updateValue(k, (np.concatenate([filed(k) if start else _NONE, fresh]).tobytes(),))
        self.next.update((accepted,))

    def close(self) -> None:
        pass


def near_duplicates(
    docs: DataFrame, site: str, seq: str, url: str, markdown: str,
    threshold: float = K.DUPLICATE_SIMILARITY, keep_ms: int = 30 * 24 * 3600 * 1000,
) -> DataFrame:
    """The rule of ``all_duplicates`` on a stream: each document of a site against the accepted ones before it.

    State is kept per site in a key-value store on the executors (RocksDB), so it need not fit in
    memory; nothing is kept longer than ``keep_ms`` after it was last written.  Order is arrival: micro-batches as they
    come, ``seq`` inside one.  The rule is sequential in a site, so a site is one key; the rows of one site in
    one micro-batch are spooled to a file of their task.  ``SETTINGS`` keep the batches small in which they come.  Run it with a clock trigger or once:
    the clock that expires state never lets an available-now run end.
    """
    d = docs.select(
        col(site).cast("string").alias("site"), col(seq).cast("long").alias("seq"), col(url).alias("url"),
        content_sha1(markdown).alias("fp"), F.coalesce(content_tokens(markdown), F.array().cast("array<string>")).alias("tokens"),
    )
    hashes = F.transform("tokens", lambda t: F.xxhash64(t))
    d = d.select("site", "seq", "url", "fp", F.array_join("tokens", " ").alias("words"), hashes.alias("h"))
    return d.groupBy("site").transformWithStateInPandas(
        NearDuplicates(threshold, keep_ms), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime")
