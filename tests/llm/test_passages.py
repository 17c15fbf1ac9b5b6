"""Source divergence, collocations and repeated passages next to plain Python, with the cases of the docstrings."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import collocations as CO, source_divergence as SD, substring_dedup as SU
from docloom.llm.common import read
from docloom.llm.suffix_array import permuted_common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, extra string, c long, number long"


def table(spark, docs):
    """Rows with nulls, repeats and columns whose names the operators use inside."""
    return spark.createDataFrame([(*d, "x", 1, 2) for d in docs], SCHEMA)


# --- suffix arrays -----------------------------------------------------------------


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_suffix_arrays(letters):
    rng = random.Random(letters)
    for _ in range(250):
        t = bytes(rng.randrange(letters) for _ in range(rng.randrange(80)))
        t = t * 3 if rng.random() < 0.3 else t
        want = sorted(range(len(t)), key=lambda i: t[i:])
        sa = suffix_array(np.frombuffer(t, np.uint8), letters)
        assert sa.tolist() == want
        shared = np.zeros(len(t), int)
        for x, y in zip(want, want[1:]):
            while shared[y] + max(x, y) < len(t) and t[x + shared[y]] == t[y + shared[y]]:
                shared[y] += 1
        assert permuted_common_prefixes(np.frombuffer(t, np.uint8), sa).tolist() == shared.tolist()


def test_suffix_array_of_a_text(spark, sf):
    t = "\n".join(r.text for r in read(spark, sf, "documents").limit(60).collect()).encode()
    sa = suffix_array(np.frombuffer(t, np.uint8), 256)
    assert np.array_equal(np.sort(sa), np.arange(len(t)))
    assert all(t[a : a + 400] <= t[b : b + 400] for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()))


def test_long_runs_of_one_character():
    t = np.frombuffer(b"a" * 300_000 + b"b" + b"a" * 1000, np.uint8)
    sa = suffix_array(t, 256)
    assert sa[0] == len(t) - 1 and sa[-1] == 300_000


# --- repeated passages ---------------------------------------------------------------


def without(texts, w):
    seen = Counter(b[i : i + w] for b in texts for i in range(len(b) - w + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - w + 1):
            if seen[b[i : i + w]] > 1:
                gone[i : i + w] = b"\1" * w
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((len(b), [list(s) for s in spans], bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("options", [
    SU.RepeatOptions(window=40, anchor=12, shard_bytes=2000, block_bytes=700), SU.RepeatOptions(window=40, anchor=12, hot_bytes=300),
    SU.RepeatOptions(window=40, anchor=40)])
def test_repeated_passages(spark, options):
    rng = random.Random(3)
    phrases = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(30, 120))) for _ in range(8)]
    texts = ["".join(rng.choice(phrases) if rng.random() < 0.5 else "".join(rng.choice("ab é") for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(8))) for _ in range(90)]
    texts += ["a" * 500, "a" * 60, None, "", texts[3], texts[3], "ab" * 300, "🙂" * 30, "x" * 39]
    docs = [(i % 40 if i % 7 else None, t, None, "s") for i, t in enumerate(texts)]
    got = SU.without_repeats(table(spark, docs), options).collect()
    want = [(d[0], *w) for d, w in zip(docs, without([(t or "").encode() for t in texts], options.window))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], str(r[2]), bytes(r[3]))
    assert sorted(((r.doc_id, r.n_bytes, r.spans, bytes(r.kept)) for r in got), key=key) == sorted(want, key=key)


def test_repeated_passages_digest(spark, sf):
    texts = {r.doc_id: (r.text or "").encode() for r in read(spark, sf, "documents").collect()}
    want = {d: w for d, w in zip(texts, without(list(texts.values()), 200))}
    for r in SU.op13_substring_dedup(spark, sf).collect():
        n, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())


# --- collocations ----------------------------------------------------------------------


def phrases_of(docs, least, top, longest=5):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and inside(p, q) for q, b in cand.items()):
                continue
            s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [
    CO.PhraseOptions(min_count=3, top=40), CO.PhraseOptions(min_count=2, top=1000, block_bytes=300, slice=4), CO.PhraseOptions(min_count=3, words=3)])
def test_collocations(spark, options):
    rng = random.Random(6)
    words = ["The", "the", "a", "b", "ç", "dd", "e-f", "g'", "Ž", "x\ty"]
    docs = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", "\t", "\n", ". ", "!"]) for _ in range(rng.randrange(25)))
        docs.append((i if i % 5 else None, text, rng.choice(["en", "de", None, ""]), None))
    docs += [(1, None, "en", "s"), (1, "", "en", "s"), (2, "q " * 4000, "fr", "s"), docs[0], docs[0]]
    got = sorted(tuple(r) for r in CO.collocations(table(spark, docs), options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == phrases_of(docs, options.min_count, options.top, options.words)


def test_collocations_join_no_words(spark, monkeypatch):
    """Words and stripes travel as a row a bucket and come back the same way: only frequent phrases are joined."""
    staged = {}

    def recorded(df, name):
        staged[name] = df._jdf.queryExecution().toString()
        return stored(df, name)

    stored = CO.stored
    monkeypatch.setattr(CO, "stored", recorded)
    docs = [(i, " ".join(f"w{i % 7}x{k}" for k in range(60)), "en", "s") for i in range(40)]
    got = sorted(tuple(r) for r in CO.collocations(table(spark, docs), CO.PhraseOptions(min_count=5, block_bytes=900)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == phrases_of(docs, 5, 2000) and got
    joins = [name for name, plan in staged.items() if "Join" in plan and not name.startswith("phrases-level")]
    assert not joins and not [name for name in staged if name.startswith("phrases-stripes")]


def test_packed_columns():
    rng = np.random.default_rng(3)
    for columns in ([rng.integers(-1, 1 << 60, 500)], [np.sort(rng.integers(0, 1 << 58, 500)), rng.integers(0, 9, 500), np.full(500, -1)], [np.array([7]), np.array([-1])], [np.zeros(0, np.int64)] * 2):
        assert (CO._unpacked(CO._packed(*columns), len(columns)) == np.array(columns)).all()


def test_collocations_of_documents(spark, sf):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in read(spark, sf, "documents").collect()]
    got = sorted(tuple(r) for r in CO.collocations(read(spark, sf, "documents"), CO.PhraseOptions(min_count=12)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == phrases_of(docs, 12, 2000) and len(got) > 100


def test_numbers_of_slices():
    o = CO.PhraseOptions(slice=100)
    ids = CO._new_numbers(7, np.array([1, 100, 101, 1000]), o)
    assert (ids >> 56).tolist() == [0, 0, 1, 4] and (ids & 0xFFFF).tolist() == [7, 8, 9, 10]
    assert CO._slice_of(ids[[3] * 50], np.arange(50)).max() < 16 and not CO._slice_of(ids[[0] * 50], np.arange(50)).any()


# --- source divergence --------------------------------------------------------------------


def audit(docs, min_docs, top):
    count, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        g = (lang or "", source or "")
        groups.add(g)
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        count[g].update(w)
        df[g[0]].update(set(w))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        own = sorted(s for x, s in groups if x == lang)
        share = lambda c, n: 1 + Fraction(1_000_000_000 * (c + 1), n + len(kept)).__floor__()
        n = {s: sum(count[lang, s][t] for t in kept) for s in own}
        p = {s: {t: share(count[lang, s][t], n[s]) for t in kept} for s in own}
        q = {t: share(sum(count[lang, s][t] for s in own), sum(n.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, x.decode(), -v, i) for part, r in (("pair", pairs), ("term", terms)) for i, (v, x) in enumerate(r, 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [SD.AuditOptions(), SD.AuditOptions(min_docs=2, top=5, shard_bytes=200, bucket_rows=7, tile=2), SD.AuditOptions(min_docs=1000)])
def test_source_divergence(spark, options):
    rng = random.Random(9)
    words = ["Alpha", "alpha", "beta", "a", "aa", "abcdefgh", "abcdefghi", "abcdefghij" * 3, "été", "ÉTÉ", "x1y", "naïve", "z" * 70]
    docs = [
        (i if i % 6 else None, " ".join(rng.choice(words) + rng.choice(["", ".", "9", "_"]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "é"]))
        for i in range(90)]
    docs += [(1, None, "en", "empty"), (1, "123 _", "only", "one"), docs[5], docs[5]]
    got = sorted(tuple(r) for r in SD.audit_sources(table(spark, docs), options).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == audit(docs, options.min_docs, options.top)


def test_sorted_pointers_and_exact_shares():
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 8, 9, 16, 17, 40]))) for _ in range(300)).encode() for _ in range(20)]
    small, SD.SMALL = SD.SMALL, 16
    try:
        words, word, group, count, docs = SD.shard_runs(texts, np.arange(20) % 3)
    finally:
        SD.SMALL = small
    assert words == sorted(set(words))
    want = Counter((w, i % 3) for i, t in enumerate(texts) for w in t.split())
    assert {(words[w], g): c for w, g, c in zip(word.tolist(), group.tolist(), count.tolist())} == want
    big = np.array([0, 1, 10**12, 10**15], np.int64)
    total, v = np.int64(2 * 10**15), 12345
    assert SD.shares(big, total, v, 1).tolist() == [1 + (10**9 * (c + 1)) // (int(total) + v) for c in big.tolist()]


@pytest.mark.parametrize("run", [SD.audit_sources, CO.collocations, SU.without_repeats])
def test_empty_tables(spark, run):
    assert run(table(spark, [(1, "x", "en", "s")]).limit(0)).count() == 0


def test_long_texts(spark):
    """One text of a million characters and one passage in the middle of another."""
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh \n") for _ in range(1_200_000))
    docs = table(spark, [(1, long, "en", "a"), (2, "x" * 50 + long[600_000:600_300] + "y" * 50, "en", "b"), (3, "short words here", "en", "a")])
    got = {r.doc_id: r for r in SU.without_repeats(docs).select("doc_id", "spans", F.length("kept").alias("n")).collect()}
    assert got[1].spans == [[600_000, 600_300]] and got[2].spans == [[50, 350]] and got[3].spans == [] and got[1].n == 1_199_700
    assert SD.audit_sources(docs).filter("part = 'pair'").count() == 2
    assert CO.collocations(docs).count() >= 0
