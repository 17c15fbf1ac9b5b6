"""Rules, array helpers, byte decoding and unlimited duplicates against plain Python."""

import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from docloom.functions import arrays as A
from docloom.functions import decisions as DE
from docloom.functions import markdown as M
from docloom.operators import chunk, htmlmd
from docloom.operators import dedupe as D
from docloom.operators import jsonwalk as J
from docloom.operators import rules as RU


def test_group_count():
    for pattern, n in [("", 0), ("a(b)(c)", 2), (r"\(a\)", 0), ("(?:a)(?<x>b)(?=c)(?<!d)", 1), ("[(](a)", 1), (r"[\](](a)(?i)(b)", 2), ("((a)(b(c)))", 4)]:
        assert RU.group_count(pattern) == n, pattern


def test_require_found(spark):
    catalog = spark.createDataFrame([("a", "Alfa"), ("b", "Beta")], "id string, nama string")
    found = RU.find_strictly(spark.createDataFrame([("ALFA",), (" b ",)], "n string"), catalog, "n", ["id", "nama"])
    assert RU.require_found(found, catalog, "n", "id").count() == 2
    missing = RU.find_strictly(spark.createDataFrame([("c",)], "n string"), catalog, "n", ["id", "nama"])
    with pytest.raises(ValueError, match="unknown: c; known: a, b"):
        RU.require_found(missing, catalog, "n", "id")


def test_arrays(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(0, 60) for _ in range(rng.randrange(0, 30))]) for i in range(40)] + [(99, None)]
    d = spark.createDataFrame(rows, "i int, v array<int>")
    got = d.select("v", A.starts_of("v").alias("s"), A.packed("v", 4, 100).alias("p"), A.first_places(F.col("v")).alias("f")).collect()
    for r in got:
        if r.v is None:
            assert r.s is None and r.p is None and r.f is None
            continue
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v))]
        assert r.f == [i for i, x in enumerate(r.v) if x not in r.v[:i]]
        no = n = total = 0
        for size, batch in zip(r.v, r.p):
            if n and (n >= 4 or total + size > 100):
                no, n, total = no + 1, 0, 0
            n, total = n + 1, total + size
            assert batch == no


def test_headings_of_a_long_text(spark):
    md = "\n".join(f"## H {i}\ntext" for i in range(50_000))
    d = spark.createDataFrame([(md,)], "md string").select(M.headings("md").alias("h"))
    n, last = d.select(F.size("h"), F.get("h", F.lit(49_999))).first()
    assert n == 50_000 and last.text == "H 49999" and md[last.offset :].lstrip("\n").startswith("## H 49999")


def test_number_text():
    for value, text in [(5, "5"), (5.0, "5"), (1e20, "1.0E+20"), (1.5e-7, "1.5E-7"), (0.1 + 0.2, "0.3"), (-2.5, "-2.5"), (10**30, "1.0E+30")]:
        assert J.number_text(value) == text


def test_json_documents(spark):
    docs = [
        {"zeta": "Laporan A", "alpha": "Laporan B", "f": "/x.pdf"},
        {"a": [{"judul": "Dalam", "l": ["u.pdf", "/x.pdf"]}], "t": "Luar", "f": "/x.pdf"},
        [["a.docx", "b c.pdf"], {"type": "file", "nama": "Nama", "url": "https://h/d.pdf"}],
        "teks", 5, None,
    ]
    rows = [(i, json.dumps(x)) for i, x in enumerate(docs)] + [(9, "{"), (10, None)]
    got = {(r.k, r.url): r.judul for r in J.json_files(spark.createDataFrame(rows, "k int, j string"), "k", "j").collect()}
    assert got == {(0, "/x.pdf"): "Laporan A", (1, "/x.pdf"): "Luar", (1, "/u.pdf"): "", (2, "/a.docx"): "b c.pdf", (2, "https://h/d.pdf"): "Nama"}
    deep = {"f": "/0.pdf"}
    for i in range(1, 30):
        deep = {"x": [deep], "f": f"/{i}.pdf"}
    d = spark.createDataFrame([(1, json.dumps(deep))], "k int, j string")
    assert J.json_files(d, "k", "j").count() == 30 and J.json_files(d, "k", "j", 8).count() == 5


def test_decode_body(spark):
    meta = '<meta charset="iso-8859-1">é'
    rows = [
        (b"\xef\xbb\xbfabc", None, "abc"), ("é".encode("latin-1"), "ISO-8859-1", "é"), ("é".encode(), None, "é"), ("é".encode("latin-1"), None, "é"),
        (meta.encode("latin-1"), None, '<meta charset="UTF-8">é'), ("€".encode("cp1252"), "windows-1252", "€"), (b"x", "no-such-charset", "x"), (None, None, None), (b"", None, ""),
    ]
    d = spark.createDataFrame([(b, h) for b, h, _ in rows], "b binary, h string")
    assert [r[0] for r in d.select(DE.decode_body("b", "h")).collect()] == [t for _, _, t in rows]


def test_decisions(spark):
    d = spark.createDataFrame([("berjalan", "/a/B.HTML", True, "x" * 60), ("SELESAI", "c.md", False, "  ")], "s string, f string, ok boolean, md string")
    got = d.select(DE.is_active_job("s"), DE.pair_name("f"), DE.parse_accepted("ok", "md", F.lit(True))).collect()
    assert [tuple(r) for r in got] == [(True, "B.md", True), (False, "c.md", False)]


def sequential(rows, threshold):
    """The rule in order, without limits: rows of (seq, url, text)."""
    seen, past, out = {}, [], {}
    for seq, url, text in sorted(rows):
        tokens = {w for w in re.split(r"[^\w]+", text.lower()) if len(w) >= 3}
        first, best, kind = seen.get(text), 0.0, None
        if first is not None:
            kind, best = ("identik" if first != url else None), 1.0
        elif tokens and threshold < 1:
            for u, t in past:
                score = len(tokens & t) / len(tokens | t)
                if score > best:
                    best, first = score, u
            kind = "mirip" if first is not None and best >= threshold else None
        if kind is None:
            seen[text] = url
            if tokens:
                past.append((url, tokens))
            out[seq] = (True, None, None, None)
        else:
            out[seq] = (False, kind, first, math.floor(best * 10000 + 0.5) / 10000)
    return out


@pytest.mark.parametrize("threshold", [0.0, 0.5, 0.8, 1.0])
def test_all_duplicates(spark, threshold):
    rng = random.Random(11)
    words = [f"kata{i}" for i in range(30)]
    rows = []
    for site in ("a", "b"):
        texts = []
        for i in range(40):
            t = " ".join(rng.choice(texts).split() if texts and rng.random() < 0.6 else rng.sample(words, rng.randrange(0, 9)))
            if rng.random() < 0.5:
                t += " " + rng.choice(words)
            texts.append(t)
            rows.append((site, i, f"https://{site}.example/{rng.randrange(25)}", t))
    df = spark.createDataFrame(rows, "site string, seq long, url string, text string").repartition(3)
    got = {(r.site, r.seq): (r.accepted, r.jenis, r.url_pertama, r.skor) for r in D.all_duplicates(df, "site", "seq", "url", "text", threshold).collect()}
    for site in ("a", "b"):
        want = sequential([r[1:] for r in rows if r[0] == site], threshold)
        assert {k[1]: v for k, v in got.items() if k[0] == site} == want


def test_threshold_zero_needs_a_partner(spark):
    df = spark.createDataFrame([("a", 1, "u1", "satu dua tiga"), ("a", 2, "u2", "empat lima enam")], "site string, seq long, url string, text string")
    for fn in (D.all_duplicates, D.greedy_duplicates):
        assert [r.accepted for r in fn(df, "site", "seq", "url", "text", 0.0).collect()] == [True, True]


def test_prefix_rows_are_thin(spark):
    """a row carries no list of words, and words that meet nothing in their site give no row."""
    texts = [("s", 1, ["aa", "bb", "cc", "lone"]), ("s", 2, ["aa", "bb", "cc"]), ("t", 3, ["far"]), ("u", 4, ["far"]), ("s", 5, None), (None, 6, ["aa", "bb"]), (None, 7, ["aa", "bb"])]
    rows = D.prefix_rows(spark.createDataFrame(texts, "site string, node long, tokens array<string>"), 0.5)
    assert not any(f.dataType.typeName() == "array" for f in rows.schema)
    assert {(r.site, r.node) for r in rows.collect()} == {("s", 1), ("s", 2)}
    assert all(n == 2 for n in rows.groupBy("site", "t").count().toPandas()["count"])


def test_sets_that_share_few_prefix_words_are_not_read(spark, monkeypatch):
    """large sets, whose marks tell nothing, are not read to verify them where they meet under too few words; similar ones are."""
    common = [f"umum{i}" for i in range(1450)]
    docs = [(i, f"u{i}", " ".join(common + [f"jarang{j}" for j in range(40 * (i // 2), 40 * (i // 2) + 40)] + [f"kata{i}x{j}" for j in range(150)])) for i in range(12)]
    names, keep = [], D.stored

    def stored(df, name, *codec):
        out = keep(df, name, *codec)
        names.append((name, out.count() if name == "duplicates-sets" else None))
        return out

    monkeypatch.setattr(D, "stored", stored)
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = lambda rows: sorted(map(tuple, D.all_duplicates(spark.createDataFrame(rows, "seq long, url string, md string").withColumn("site", F.lit("s")), "site", "seq", "url", "md", 0.85).select("seq", "accepted", "url_pertama").collect()))
    assert found(docs) == [(i, True, None) for i in range(12)]
    assert sum(n or 0 for _, n in names) == 0
    assert found([*docs, (12, "u12", docs[3][2] + " satu")])[-1] == (12, False, "u3")
    assert [n for x, n in names if x == "duplicates-sets"] == [2, 2]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_markdown_tasks_follow_the_pages(spark, monkeypatch):
    """more pages are more tasks, whatever the session's number of shuffle partitions; the text is the same."""
    pages = spark.createDataFrame([(i, f"<body><h1>T{i}</h1><p>one {i}</p><ul><li>a<li>b</ul></body>") for i in range(40)], "page_id long, html string")
    before = sorted(htmlmd.html_to_markdown(pages).collect())
    monkeypatch.setattr(htmlmd, "PAGES_PER_TASK", 1)
    many = htmlmd.html_to_markdown(pages)
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(many.collect()) == before and before[3].markdown == "# T3\n\none 3\n\n- a\n\n- b"


def test_windows_leave_the_worker_in_small_batches(spark, monkeypatch):
    """rows of windows are handed on a few at a time and stay with their texts; nulls have none."""
    monkeypatch.setattr(chunk, "WINDOW_ROWS", 3)
    texts = [(i, None if i % 7 == 0 else "word. " * i) for i in range(50)]
    got = spark.createDataFrame(texts, "i int, t string").coalesce(1).select("i", chunk.windows("t", 40, 5).alias("w")).collect()
    for r in got:
        t = texts[r.i][1] or ""
        want = [(s, c, t[s:c].strip()) for s, c in chunk._cut_points(t, 40, 5) if t[s:c].strip()]
        assert [tuple(x) for x in r.w] == want


def test_chunk_filter_reasons_works_windows_out_once(spark, sf):
    """the windows are cut by one operator of the plan."""
    from docloom.plans.chunk_queries import chunk_filter_reasons

    plan = chunk_filter_reasons(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[cut(") == 1


def test_blocks_are_rendered_once_and_tokens_sorted_few_times(spark):
    """no filter renders a block a second time; what goes by position alone shares one order of the tokens."""
    html = "<body><p>a <b>b</b>  c</p><p> </p><hr><div class='menu'>x</div><table><tr><td><td>1|2</table><h2></h2><h2>T</h2>"
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    md = htmlmd.html_to_markdown(pages)
    plan = md._jdf.queryExecution().executedPlan().toString()
    rendered = [line for line in plan.split("+- ") if "\u0005\\s*(\u0006|$)" in line]
    assert len(rendered) == 1 and "Filter" not in rendered[0][:20]
    assert len(re.findall(r"\bSort \[", plan)) <= 11  # two of them for the join with the titles
    assert {r.page_id: r.markdown for r in md.collect()} == {1: "a **b** c\n\n---\n\nx\n\n| | 1\\|2 |\n| --- | --- |\n\n## T", 2: ""}


def test_headings_are_found_once(spark):
    """the headings of a text are worked out in one pass, not again for each use; only \\n ends a line."""
    texts = [(0, "# a\nx\n  ## b c\n"), (1, None), (2, ""), (3, "é\n# q\r\n#  Page 3\n#\n####### z\n# \u0085 w  v")]
    d = spark.createDataFrame(texts, "i int, md string")
    got = {r.i: r.h if r.h is None else [tuple(x) for x in r.h] for r in d.select("i", M.headings("md").alias("h")).collect()}
    assert got == {0: [(0, "a"), (6, "b c")], 1: None, 2: [], 3: [(2, "q\r"), (7, "Page 3"), (29, "\u0085 w  v")]}
    plan = chunk.with_windows(d, "md", chunk.ChunkOptions())._jdf.queryExecution().executedPlan().toString()
    assert "(.+)$" not in plan
