"""Streaming near duplicates: the decision of the batch operator, growing and expiring state."""

import hashlib
import random
import tracemalloc
import time

import numpy as np
import pandas as pd
import pytest

from docloom.streaming import live, near
from test_crawl_flow import _sequential

SCHEMA = "site string, seq long, url string, md string"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omikron rho sigma tau upsilon phi chi psi omega"


def _write(folder, name, rows):
    pd.DataFrame(rows, columns=["site", "seq", "url", "md"]).to_parquet(folder / name, index=False)


def _run(spark, folder, base, keep_ms):
    """One micro-batch over the new files of a folder, on the state of earlier runs."""
    docs = spark.readStream.schema(SCHEMA).parquet(str(folder))
    before = spark.conf.get(live.STATE_STORE, None)
    spark.conf.set(live.STATE_STORE, live.ROCKSDB)
    w = near.near_duplicates(docs, "site", "seq", "url", "md", keep_ms=keep_ms).writeStream
    q = w.option("checkpointLocation", f"{base}/state").trigger(once=True).format("parquet").option("path", f"{base}/rows").start()
    q.awaitTermination()
    spark.conf.unset(live.STATE_STORE) if before is None else spark.conf.set(live.STATE_STORE, before)
    return live.state_sizes(q)[-1]


def _rows(spark, base):
    return {r.seq: (r.accepted, r.jenis, r.url_pertama, r.skor) for r in spark.read.schema(near.OUT).parquet(f"{base}/rows").collect()}


def test_near_duplicates_over_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder, "a.parquet", [("s", 1, "u1", BASE), ("s", 2, "u2", BASE + " extra"), ("t", 3, "u3", BASE)])
    first = _run(spark, folder, tmp_path, 3_600_000)
    _write(folder, "b.parquet", [("s", 5, "u5", BASE), ("s", 6, "u1", BASE), ("s", 4, "u4", "other words entirely"), ("s", 7, "u7", ""), ("s", 8, "u8", "")])
    second = _run(spark, folder, tmp_path, 3_600_000)
    assert _rows(spark, tmp_path) == {
        1: (True, None, None, None), 2: (False, "mirip", "u1", round(20 / 21, 4)), 3: (True, None, None, None),
        4: (True, None, None, None), 5: (False, "identik", "u1", 1.0), 6: (True, None, None, None),
        7: (True, None, None, None), 8: (False, "identik", "u7", 1.0),
    }
    assert second["rows"] > first["rows"] > 0 and second["bytes"] > 0


def test_old_state_expires(spark, tmp_path):
    """A copy that comes after its first text has expired is new again."""
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder, "a.parquet", [("s", 1, "u1", BASE)])
    _run(spark, folder, tmp_path, 3000)
    time.sleep(3.5)
    _write(folder, "b.parquet", [("s", 2, "u2", BASE)])
    _run(spark, folder, tmp_path, 3000)
    assert {k: v[0] for k, v in _rows(spark, tmp_path).items()} == {1: True, 2: True}


def test_first_seen_texts_forgets(spark):
    df = spark.readStream.format("rate").load().selectExpr("'s' AS site", "string(value) AS text", "timestamp AS ts")
    plan = live.first_seen_texts(df, "site", "text", "ts", "1 hour")
    assert plan.isStreaming and "fingerprint" in plan.columns


class _Held:
    """A state of a processor in plain Python; counts what is read."""

    def __init__(self):
        self.rows, self.reads = {}, 0

    def getValue(self, key):
        self.reads += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value

    def iterator(self):
        return iter(self.rows.items())

    def exists(self):
        return () in self.rows

    def get(self):
        return self.rows[()]

    def update(self, value):
        self.rows[()] = value


class _Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _Held())

    getValueState = getMapState


class _Timer:
    def getCurrentProcessingTimeInMs(self):
        return 1_000_000


def _hash(word):
    return int.from_bytes(hashlib.md5(word.encode()).digest()[:8], "little", signed=True)


def _feed(batches, ttl_ms=3_600_000):
    """Results of one site's micro-batches of (seq, url, text), and the state."""
    processor, handle, got = near.NearDuplicates(0.85, ttl_ms), _Handle(), {}
    processor.init(handle)
    for batch in batches:
        words = [list(dict.fromkeys(w for w in t.split() if len(w) >= 3)) for _, _, t in batch]
        h = [np.array([_hash(w) for w in ws], np.int64) for ws in words]
        rows = pd.DataFrame({"seq": [b[0] for b in batch], "url": [b[1] for b in batch], "fp": [b[2] for b in batch], "words": [" ".join(ws) for ws in words]})
        rows["h"] = pd.Series(h, dtype=object)
        for out in processor.handleInputRows(("a",), iter([rows]), _Timer()):
            got |= {r.seq: (r.accepted, r.jenis, r.url_pertama, r.skor) for r in out.astype(object).where(out.notna(), None).itertuples()}
    return got, handle.states


@pytest.mark.parametrize("sizes", [[400], [1, 1, 3, 40, 5, 150, 200]])
def test_orders_of_a_growing_site(monkeypatch, sizes):
    """documents filed under older orders of words are found under each newer one."""
    monkeypatch.setattr(near, "_FIRST", 2)
    monkeypatch.setattr(near, "_ROWS", 16)
    rng = random.Random(len(sizes))
    words = [f"w{i:03d}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(rng.randrange(3, 30))] for _ in range(30)]
    docs = []
    for i in range(sum(sizes)):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((i, f"u{i % 190}", " ".join(w if rng.random() < 0.9 else w[: rng.randrange(3)])))
    batches, at = [], 0
    for n in sizes:
        batches.append(docs[at : at + n])
        at += n
    got, states = _feed(batches)
    assert got == _sequential([("a", *d) for d in docs], 0.85)
    assert len(states["orders"].rows) > (1 if len(sizes) > 1 else 0)


def test_common_words_read_no_documents():
    """F2: texts that share common words only are not read to compare them, neither in a micro-batch nor across."""
    rng = random.Random(7)
    common = [f"umum{i}" for i in range(40)]
    docs = [(i, f"u{i}", " ".join(common + [f"kata{rng.randrange(10**9)}" for _ in range(40)])) for i in range(300)]
    got, states = _feed([docs[:200], docs[200:]])
    assert all(v[0] for v in got.values()) and states["docs"].reads == 0
    # a word's entries are read once in a micro-batch, not once for each document
    assert states["index"].reads <= len({w for d in docs[200:] for w in d[2].split()})


def test_entries_of_expired_documents_go(monkeypatch):
    """entries as old as ``ttl_ms`` are not read nor written again."""
    half = " ".join(sorted(BASE.split(), key=_hash)[:10])  # filed under words of the whole text
    batches = [[(1, "u1", BASE)], [(2, "u2", half)]]
    _, states = _feed(batches, ttl_ms=5)
    assert max(len(v[0]) // 56 for v in states["index"].rows.values()) == 2
    clock = iter([0, 10])
    monkeypatch.setattr(_Timer, "getCurrentProcessingTimeInMs", lambda self: next(clock))
    _, states = _feed(batches, ttl_ms=5)
    assert {len(v[0]) // 56 for v in states["index"].rows.values()} == {1}


class _Gone(_Held):
    """A state that keeps nothing."""

    def updateValue(self, key, value):
        pass


def test_a_micro_batch_is_not_held_in_memory():
    """texts and prefixes of a site's rows lie in files; the rows come from an iterator and go again."""
    handle, processor = _Handle(), near.NearDuplicates(0.85, 3_600_000)
    handle.states["docs"] = _Gone()
    processor.init(handle)

    def frames():
        for i in range(0, 600, 20):
            words = [[f"{'x' * 50_000}{j}", f"{'y' * 50_000}{j}"] for j in range(i, i + 20)]
            f = pd.DataFrame({"seq": range(i, i + 20), "url": [f"u{j}" for j in range(i, i + 20)], "fp": [f"f{j}" for j in range(i, i + 20)], "words": [" ".join(w) for w in words]})
            f["h"] = pd.Series([np.array([_hash(x) for x in w], np.int64) for w in words], dtype=object)
            yield f

    tracemalloc.start()
    try:
        rows = sum(int(out.accepted.sum()) for out in processor.handleInputRows(("a",), frames(), _Timer()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 600 and peak < 30_000_000  # the texts are 60 MB
