"""Operators on small fixtures, against brute force where the rule is sequential."""

import random
from collections import deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docloom.operators import clean as C, dedupe as D, frontier as FR, skew as SK, status as ST, vectors as V
from docloom.operators.htmlmd import html_to_markdown
from docloom.operators.jobs import attempts
from docloom.operators.jsonwalk import json_files
from docloom.operators.links import extract_links


def greedy_by_hand(docs, threshold, history):
    """The sequential rule, one document at a time."""
    seen, recent, out = {}, {}, {}
    for site, seq, url, text in sorted(docs, key=lambda d: (d[0], d[1])):
        tokens = []
        for w in "".join(c if c.isalnum() else " " for c in text.lower()).split():
            if len(w) >= 3 and w not in tokens:
                tokens.append(w)
        tokens = set(tokens[:600])
        first = seen.get((site, text))
        past = recent.setdefault(site, deque())
        kind, ref = None, None
        if first is not None:
            if first != url:
                kind, ref = "identik", first
        elif tokens and threshold < 1:
            best = 0.0
            for u, ts in past:
                k = len(tokens & ts)
                s = k / (len(tokens) + len(ts) - k)
                if s > best:
                    best, ref = s, u
            kind = "mirip" if best >= threshold else None
        if kind is None:
            seen[(site, text)] = url
            if tokens:
                past.append((url, tokens))
                if len(past) > history:
                    past.popleft()
            ref = None
        out[(site, seq)] = (kind, ref)
    return out


@pytest.mark.parametrize("history, segment", [(300, 5000), (4, 7), (3, 16)])
def test_greedy_duplicates_equal_the_sequential_rule(spark, history, segment):
    rng = random.Random(history * 31 + segment)
    words = [f"kata{i}" for i in range(60)]
    bases = [rng.sample(words, 20) for _ in range(5)]
    docs = []
    for i in range(140):
        b = list(bases[0] if rng.random() < 0.4 else rng.choice(bases))  # one template is hot
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            b[rng.randrange(20)] = rng.choice(words)
        site = "a" if rng.random() < 0.7 else "b"
        docs.append((site, i, f"https://{site}/{i}", " ".join(b) if i % 17 else "a b"))
    df = spark.createDataFrame(docs, "site string, seq long, url string, md string")
    got = D.greedy_duplicates(df, "site", "seq", "url", "md", 0.85, history, segment).collect()
    assert len(got) == len(docs)
    assert {(r.site, r.seq): (r.jenis, r.url_pertama) for r in got} == greedy_by_hand(docs, 0.85, history)


def test_similarity_threshold(spark):
    w = [f"w{i:03d}" for i in range(30)]
    a, b18, b19 = w[:20], w[:18] + w[20:22], w[:19] + w[20:21]
    df = spark.createDataFrame(
        [("s", 0, "u0", " ".join(a)), ("s", 1, "u1", " ".join(b18)), ("t", 0, "v0", " ".join(a)), ("t", 1, "v1", " ".join(b19))],
        "site string, seq long, url string, md string",
    )
    got = {r.url: (r.accepted, r.skor) for r in D.greedy_duplicates(df, "site", "seq", "url", "md").collect()}
    assert got["u1"] == (True, None)
    assert got["v1"] == (False, 0.9048)


def test_row_numbers_over_a_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") * 7919 % 5003).alias("o"),
    )
    got = SK.running_row_number(df, ["k"], [F.col("o")], "rn", 8)
    rows = got.collect()
    want = {}
    for r in sorted(rows, key=lambda r: (r.k, r.o)):
        want[r.k] = want.get(r.k, 0) + 1
        assert r.rn == want[r.k]
    top = SK.top_per_key(df, ["k"], [F.desc("o")], 3).collect()
    hot = sorted((r.o for r in rows if r.k == "hot"), reverse=True)[:3]
    assert sorted((r.o for r in top if r.k == "hot"), reverse=True) == hot


def test_batches(spark):
    df = spark.createDataFrame([([10, 10, 10, 50],), ([],)], "s array<int>")
    got = [r.b for r in df.select(V.pack_batches("s", 2, 30).alias("b")).collect()]
    assert got == [[0, 0, 1, 2], []]


def test_dimensions(spark):
    good = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 1.0])], "id long, vector array<double>")
    assert V.require_one_dimension(good) == 2
    mixed = good.union(spark.createDataFrame([(3, [1.0])], good.schema))
    for bad, kw in [(mixed, {}), (good.limit(0), {}), (good, {"expected": 3})]:
        with pytest.raises(ValueError):
            V.require_one_dimension(bad, **kw)


def test_empty_headings_and_cleaning(spark):
    cases = [(["# A", "# B", "text"], ["# B", "text"]), (["# A", "## B", "text", "# C"], ["# A", "## B", "text"])]
    for blocks, want in cases:
        df = spark.createDataFrame([(blocks,)], "b array<string>")
        assert df.select(C.drop_empty_headings(F.col("b")).alias("x")).first().x == want
    md = "<!-- x -->\n[Beranda](/)\n\n[A](\\a)\n[B](\\b)\n\n# Judul\n\nIsi paragraf yang panjang sekali.\n\nIsi  paragraf yang panjang sekali.\n\n## Akhir"
    r = C.with_clean_markdown(spark.createDataFrame([(md,)], "m string"), "m").first()
    assert r.bersih == "# Judul\n\nIsi paragraf yang panjang sekali."
    assert [r[c] for c in C.COUNTERS] == [1, 0, 0, 0, 2, 1, 1]


HTML = """<html><head><title>T &amp; x</title><script>if (a < b) { x("</p>") }</script></head><body><nav><a href="/x">X</a></nav>
<div class="share-box">share me</div><h1>Main <em>one</em></h1><p>Hello <b>bold <a href="/a">link</a></b> and <a href="#z">no</a> <br>x <i> it </i>.
<p>Second <code>c d</code> <img src="i.png" alt="im"></p><ul><li>one<li>two <a href="http://q">q</a><ul><li>in1</li></ul></li></ul>
<ol><li>a</li><li></li><li>c</li></ol><table><tr><th>A|b</th><th>B</th></tr><tr><td>1</td></tr></table>
<blockquote><p>quo</p><p>te</p></blockquote><pre>x
  y</pre><hr><dl><dt>term</dt><dd>def <b>z</b></dd></dl>tail<form><input>zz</form></body></html>"""
WANT = """# Main one

Hello **bold [link](/a)** and no x *it*.

Second `c d` ![im](i.png)

- one

- two [q](http://q)

 - in1

1. a

3. c

| A\\|b | B |
| --- | --- |
| 1 | |

> quo

> te

```
x
 y
```

---

term

def z

tail"""


def test_html_to_markdown(spark):
    long = "<body><div id=a><p>" + "kata " * 100 + "</p></div><p>pendek</p></body>"
    df = spark.createDataFrame(
        [(1, HTML), (2, ""), (3, "<p>only</p>"), (4, long), (5, "<div>a<!-- x --></b>b</div></section>c")],
        "page_id long, html string",
    )
    got = {r.page_id: (r.title, r.markdown) for r in html_to_markdown(df).collect()}
    assert got[1] == ("T & x", WANT)
    assert got[2] == ("", "") and got[3] == ("", "only")
    assert got[4] == ("", ("kata " * 100).strip())  # the shortest element with most of the text
    assert got[5] == ("", "ab\n\nc")


def test_links(spark):
    html = """<base href="/d/"><a href='x'>1</a><!-- <a href="no">2</a> --><A HREF=y>3</A><a href="x#f">4</a>
    <area href="/z"><embed src="p.pdf"><object data="o.pdf"></object><a data-href="q">5</a><iframe src="mailto:a"></iframe>"""
    df = spark.createDataFrame([(1, "https://h/a/b", html)], "page_id long, url string, html string")
    got = extract_links(df, "page_id", "url", "html").orderBy("link_no").collect()
    assert [r.link for r in got] == [f"https://h{p}" for p in ["/x", "/y", "/z", "/o.pdf", "/p.pdf"]]
    # the base address is normalised too and loses its slash, so links resolve against "/"
    kept = extract_links(df, "page_id", "url", "html", ["pdf"]).count()
    assert kept == 3


def test_breadth_first(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d")], "src string, dst string")
    s = spark.createDataFrame([("a",)], "url string")
    got = {r.url: r.depth for r in FR.breadth_first(s, e).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert {r.url for r in FR.breadth_first(s, e, 1).collect()} == {"a", "b", "c"}


def test_retry_chain(spark):
    j = spark.createDataFrame([(i, i - 1 if i % 10 else None) for i in range(1, 40)], "job long, dari long")
    got = {r.job: (r.akar, r.percobaan) for r in attempts(j, "job", "dari").collect()}
    # job 1 names job 0, which is unknown: the chain starts there
    assert got[25] == (20, 6) and got[30] == (30, 1) and got[39] == (30, 10)


def test_site_skipping_and_status(spark):
    sites = spark.createDataFrame([("a", ["u1", "u2"]), ("b", ["u1"]), ("c", [])], "id string, start_urls array<string>")
    hist = spark.createDataFrame([("u1", "success"), ("u2", "failed_akses")], "url string, status string")
    left = {r.id for r in ST.skip_finished_sites(sites, hist, "id", "start_urls").collect()}
    assert left == {"a", "c"}
    r = spark.range(1).select(
        ST.run_status(F.lit(0), F.lit(0), F.lit(0)).alias("r"),
        ST.site_outcome(F.lit(3), F.lit(3)).alias("x"), ST.site_outcome(F.lit(0), F.lit(0)).alias("y"),
    ).first()
    assert tuple(r) == ("SUKSES", "failed_akses", "success")


def test_json_depth_and_titles(spark):
    body = '{"a":{"judul":"file","name":"Nama","f":"x/y.pdf"},"l":["a.pdf","b.pdf"],"u":"https://h/z.docx"}'
    got = {r.url: r.judul for r in json_files(spark.createDataFrame([(1, body), (2, "{bad")], "k long, b string"), "k", "b").collect()}
    assert got == {"/x/y.pdf": "Nama", "/a.pdf": "", "/b.pdf": "", "https://h/z.docx": ""}


class _Words(str):
    read = 0

    def split(self, *a):
        _Words.read += 1
        return str.split(self, *a)


def test_scan_compares_what_can_be_similar():
    """F8, F9: texts that share common words only are told apart by size and mark; their words are not read."""
    rng = np.random.default_rng(3)
    n = 400
    h = np.concatenate([np.r_[np.arange(40) * 2**25, rng.integers(0, 2**62, 40)] for _ in range(n)]).astype(np.int64)
    docs = pd.DataFrame({"site": "s", "seg": 0, "seq": range(n), "url": [f"u{i}" for i in range(n)], "fp": [f"f{i}" for i in range(n)]})
    docs["words"] = pd.Series([_Words(f"kata{i} lain") for i in range(n)], dtype=object)
    docs["n"] = 80
    docs[D._MARK] = D.set_marks(h, np.full(n, 80))
    state = pd.DataFrame({c: pd.Series(dtype=object) for c in ["site", "seg", "pos", "url", "fp", "words", "n", *D._MARK]})
    out = D._scan_segment(0.85, 300)(docs, state)
    assert (out.accepted == True).sum() == n and out.pos.notna().sum() == 300  # noqa: E712
    assert _Words.read == 0
    assert out[out.pos.notna()][D._MARK].to_numpy(np.int64).tolist() == docs[D._MARK].to_numpy()[-300:].tolist()


def test_marks_reach_the_next_segment_whole(spark):
    """F8, F9: what a segment hands over keeps its marks next to texts that were accepted earlier."""
    words = [f"w{i:03d}" for i in range(400)]
    texts = [" ".join(words[i * 40 : i * 40 + 40]) for i in range(8)]
    docs = [("s", i, f"u{i}", t) for i, t in enumerate(texts)]
    docs += [("s", 8, "u8", texts[0]), ("s", 9, "u9", texts[5] + " tambah"), ("s", 10, "u10", texts[6] + " lagi")]
    df = spark.createDataFrame(docs, "site string, seq long, url string, md string")
    got = {r.seq: (r.jenis, r.url_pertama) for r in D.greedy_duplicates(df, "site", "seq", "url", "md", segment_rows=8).collect()}
    assert got == {**{i: (None, None) for i in range(8)}, 8: ("identik", "u0"), 9: ("mirip", "u5"), 10: ("mirip", "u6")}
