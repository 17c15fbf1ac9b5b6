"""Golden cases of single functions."""

import uuid

import pytest
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import html as H, ids as I, logs as L, markdown as M, text as T, titles as TI, urls as U
from docloom.operators import chunk as C, clean as CL, links as LK
from docloom.operators import rules as RU
from docloom.plans import clean_queries
from docloom.sinks import writers as WR


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} {t}" for n, t in zip(names, map(kind, values))))
    return df.select(f(*[F.col(n) for n in names]).alias("x")).first()["x"]


def kind(v):
    return {bool: "boolean", int: "long", float: "double", str: "string", bytes: "binary", list: "array<string>"}[type(v)]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://example.com/", "28c8b184-ea0a-52c7-bd31-56f0f8bf165f"),
        ("https://contoh.id/é?q=ü", str(uuid.uuid5(uuid.UUID(K.DOCUMENT_NAMESPACE), "https://contoh.id/é?q=ü"))),
    ],
)
def test_document_id(spark, url, want):
    assert one(spark, I.document_id, url) == want


def test_file_name_and_point_id(spark):
    u = "https://example.com/"
    assert one(spark, U.document_file_name, u) == "example-com-beranda--28c8b184.html"
    doc = "0d19ccff-6467-58b5-8be3-d478d0eb3d07"
    assert one(spark, lambda c, d: I.point_id(c, d, F.lit(0), F.lit(9)), doc + ":0", doc) == "bb654ff8-bb68-5419-b5fe-7e5d62878153"
    assert one(spark, lambda c, d: I.point_id(c, d, F.lit(0), F.lit(9)), "42", doc) == "42"
    assert one(spark, lambda c, d: I.point_id(c, d, F.lit(0), F.lit(9)), doc.upper(), doc) == doc
    assert one(spark, I.content_sha256, "Judul") == "93b404918e8f4ff5525c8053a9a7e7629436718e3712167b5f435341bd294cab"


@pytest.mark.parametrize(
    "text, size, overlap, want",
    [
        ("aaaa. bbbb. cccc", 8, 2, [("aaaa. bb", 0), ("bbbb. cc", 6), ("cccc", 12)]),
        ("aaaa. bbbb. cccc", 7, 2, [("aaaa.", 0), ("a. bbbb", 3), ("bb. ccc", 8), ("ccc", 13)]),
        ("para one.\n\npara two is here", 14, 3, [("para one.", 0), ("e.\n\npara two i", 7), ("o is here", 18)]),
        (" \n ", 8, 2, []),
    ],
)
def test_windows(spark, text, size, overlap, want):
    got = one(spark, lambda c: C.windows(c, size, overlap), text)
    assert [(w["text"], w["start"]) for w in got] == want


@pytest.mark.parametrize(
    "href, base, want",
    [
        ("/a//b/./c/?utm_source=x&b=2&a=1#f", "https://Ex.Go.Id:443/dir/page", "https://ex.go.id/a/b/c?a=1&b=2"),
        ("img/x.png", "https://h/dir/page", "https://h/dir/img/x.png"),
        ("?p=2", "https://h/dir/page", "https://h/dir/page?p=2"),
        ("//cdn.h/x", "https://h/", "https://cdn.h/x"),
        ("../up", "https://h/dir/page", "https://h/dir/../up"),
        ("/a b?x=1&amp;y=%20z", "http://h:8080/q", "http://h:8080/ab?x=1&y=%20z"),
        ("mailto:a@b", "https://h/", None),
        ("#x", "https://h/", None),
        ("javascript:x", "https://h/", None),
    ],
)
def test_normalize_url(spark, href, base, want):
    assert one(spark, U.normalize_url, href, base) == want


@pytest.mark.parametrize(
    "host, want",
    [("otda.situs.go.id", "situs.go.id"), ("www.lain.go.id", "lain.go.id"),
     ("m.ththth.example.net", "example.net"), ("a.b.co.uk", "b.co.uk"), ("10.0.0.1", "0.1")],
)
def test_registrable_domain(spark, host, want):
    assert one(spark, U.registrable_domain, host) == want


def test_labels_targets_and_chunk_text(spark):
    assert one(spark, M.tidy_label, "Informasi Publik Informas...") == "Informasi Publik"
    assert one(spark, M.tidy_label, "Beranda Beranda") == "Beranda"
    assert one(spark, M.fix_link_targets, r"x](\profil\sejarah) y](\\) z](a) w](#b) v](tel:1)") == (
        "x](/profil/sejarah) y](//) z](/a) w](#b) v](tel:1)"
    )
    assert one(spark, M.clean_chunk_text, "### Judul\n[Berita](https://x) **tebal** C# ###### KEPUTUSAN") == (
        "Judul\nBerita tebal C# KEPUTUSAN"
    )
    assert one(spark, M.link_ratio, "[a](http://x)") == pytest.approx(12 / 13)


@pytest.mark.parametrize(
    "line, want",
    [(x, True) for x in [
        "Beranda", "- Menu", "Publikasi Publikas...", "© 2025 X", "a@b.go.id", "12", "10 / page",
        "Menampilkan 1 - 4 dari total 4", "---", "Jl. Merdeka No. 7", "| --- |", "A quick apple", "sss",
        "Aplikasi ver 2.1.2 Satu Data", "Layanan Layanan Publik", "hak cipta oleh siapa pun di sini"]]
    + [(x, False) for x in ["## Berita", "Isi paragraf lengkap kalimat panjang.", "| a | b | c |"]],
)
def test_noise(spark, line, want):
    assert one(spark, M.is_noise_line, line) is want


@pytest.mark.parametrize(
    "block, want",
    [("[A](/a) [B](/b)", "label"), ("[Beranda](/)", "label"), ("Republik Indonesia", "label"),
     ("(021) 3450038", "label"), ("[Unduh PDF](/x.pdf)", "navigasi"), ("Total 12 item", "isi"),
     ("# H", "isi"), ("| x |", "isi"), ("[x](tel:1)", "label"), ("", "isi")],
)
def test_block_kind(spark, block, want):
    assert one(spark, M.block_kind, block) == want


def test_entities_and_spaces(spark):
    assert one(spark, T.decode_entities, "a &amp;lt; &copy; &#39;x&#x41; &bogus; &rarr;") == "a &lt; © 'xA &bogus; →"
    assert one(spark, T.normalize_whitespace, "a \t b\r\n\r\n\n\n c ") == "a b\n\n c"
    assert one(spark, lambda c: T.one_line(c, 8), "a  b\ncdefghij") == "a b c..."
    assert one(spark, T.slug, "  Ab--C d! ") == "ab-c-d"
    assert one(spark, T.slug, "!!") == "halaman"
    assert one(spark, T.word_count, "it's a-b 5kg -x naïve 12") == 5


@pytest.mark.parametrize("n, want", [(1023, "1023B"), (1024, "1.0KB"), (1536, "1.5KB"), (1048576, "1.00MB")])
def test_human_bytes(spark, n, want):
    assert one(spark, T.human_bytes, n) == want


def test_formats(spark):
    assert one(spark, T.duration_minutes, 710.4) == "11.84 menit"
    assert one(spark, L.run_date, "RUN-20260916-031217") == "2026-09-16"
    assert one(spark, L.run_time, "RUN-20260916-031217") == "03:12:17"
    assert one(spark, L.run_date, "DOK-1") == ""
    assert [WR.timeout_seconds(v) for v in (120, 10000, 1500, -5, "x")] == [120, 10, 2, 120, 120]
    assert WR.normalize_distance(" cosine") == "Cosine"
    with pytest.raises(ValueError):
        WR.normalize_distance("near")
    assert one(spark, L.field_value, 'a "b"') == "\"a 'b'\""


def test_asof(spark):
    heads = F.array(*[F.struct(F.lit(o).alias("offset"), F.lit(t).alias("text")) for o, t in [(0, "A"), (50, "B"), (80, "C")]])
    assert one(spark, lambda s: M.heading_at(heads, s, F.lit(10)), 60) == "B"
    heads2 = F.array(*[F.struct(F.lit(o).alias("offset"), F.lit(t).alias("text")) for o, t in [(5, "X"), (20, "Y")]])
    assert one(spark, lambda s: M.heading_at(heads2, s, F.lit(30)), 0) == "Y"
    marks = F.array(*[F.struct(F.lit(o).alias("offset"), F.lit(p).alias("page")) for o, p in [(10, 1), (100, 2)]])
    assert one(spark, lambda s: M.page_at(marks, s), 0) == 1
    assert one(spark, lambda s: M.page_at(marks, s), 100) == 2
    none = F.array().cast("array<struct<offset:int,page:int>>")
    assert one(spark, lambda s: M.page_at(none, s), 5) is None


def test_titles(spark):
    assert one(spark, TI.looks_like_file_name, "example-com-beranda--28c8b184.html")
    assert not one(spark, TI.looks_like_file_name, "Judul biasa")
    assert one(spark, TI.looks_generic, " Lampiran ")
    assert one(spark, U.title_from_url, "https://h/profil/sejarah-singkat_a") == "Profil Sejarah Singkat A"
    assert one(spark, H.document_title, "<meta property='og:title' content='X &amp; Y'><h1> </h1>") == "X & Y"


def test_robots(spark):
    body = "User-agent: *\r\nDisallow: /a # x\r\nAllow: /a/b\r\n"
    df = LK.parse_robots(spark.createDataFrame([("h", body)], "host string, b string"), "b")
    links = spark.createDataFrame([("h", f"https://h{p}") for p in ["/a/b/c", "/a/x", "/"]], "host string, link string")
    got = {r.link: r.allowed for r in LK.check_robots(links, df, "host").collect()}
    assert got == {"https://h/a/b/c": True, "https://h/a/x": False, "https://h/": True}


def test_rules(spark):
    pats = ["/berita/([0-9]+)", ""]
    assert one(spark, lambda u: RU.first_rule(u, pats), "https://h/BERITA/7") == 1
    assert one(spark, lambda u: RU.first_rule(u, pats), "https://h/x") == 2
    assert one(spark, lambda u: RU.rule_groups(u, pats), "https://h/berita/7") == ["7"]


def test_binary_kinds(spark):
    assert one(spark, H.extension_from_content, b"%PDF-1.4 x") == "pdf"
    assert one(spark, H.extension_from_content, b"PK\x03\x04 word/document.xml") == "docx"
    assert one(spark, H.extension_from_content, b"\xd0\xcf\x11\xe0 Workbook") == "xls"
    assert one(spark, H.extension_from_content, b"  {\\rtf1") == "rtf"
    assert one(spark, H.extension_from_content, b"GIF89a") is None
    assert one(spark, H.looks_like_scanned_pdf, b"%PDF /Image ") is True


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("f", [M.fix_link_targets, M.tidy_link_labels, CL.split_blocks])
def test_text_rules_work_their_text_out_once(spark, f):
    """F16: an expression handed to a rule stands in the plan once, however often the rule looks at it."""
    df = spark.createDataFrame([("x",)], "c string")
    assert _plan(df.select(f(F.sha1("c")).alias("x"))).count("sha1(") == 1


def test_block_kinds_reads_the_page_once(spark, tmp_path):
    """F16: blocks are worked out once, and a page without html gives none."""
    page = '<h1>J</h1><a href="/a">Satu</a><p>isi yang cukup panjang untuk tinggal</p>'
    spark.createDataFrame([(1, page), (2, None)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    df = clean_queries.block_kinds(spark, str(tmp_path))
    assert _plan(df).count("html#") <= 6
    got = {(r.page_id, r.no): r.jenis for r in df.collect()}
    assert {k[0] for k in got} == {1} and [got[1, n] for n in range(1, len(got) + 1)].count("isi") >= 2
