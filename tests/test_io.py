"""Readers, writers, services and streams on files made here."""

import json

import pytest
from pyspark.sql import functions as F

from docloom.plans import ingest as I
from docloom.operators.chunk import ChunkOptions
from docloom.session import table
from docloom.sinks import writers as WR
from docloom.sources import readers as R, services as S
from docloom.streaming import live


def test_numbered_lines_across_splits(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text("\n".join(f"baris {i}" for i in range(1, 2001)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = R.numbered_lines(spark, str(p)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2000 and all(r.value == f"baris {r.line_no}" for r in rows)


def test_points_of_broken_files(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text(
        '{"chunk_id":7,"embedding":[1,2]}\nbukan json\n\n{"document_id":"d","embedding":[]}\n{"document_id":"d","embedding":[0.5]}\n'
    )
    got = {r.line_no: (r.point_id, r.vector, r.masalah) for r in R.read_points(spark, str(tmp_path / "r.jsonl")).collect()}
    assert got[1] == ("7", [1.0, 2.0], None)
    assert got[2][2] == "JSON tidak valid" and got[4][2] == "field embedding kosong"
    assert 3 not in got and got[5][1] == [0.5]


def test_manifests_and_line_counts(spark, tmp_path):
    d = tmp_path / "situs-a"
    d.mkdir()
    (d / "r1.manifest.json").write_text(json.dumps({"run_id": "R1", "dibuat": "2026-01-02 03:04:05", "dokumen": 2}, indent=1))
    (d / "r1.jsonl").write_text("a\nb\n")
    m = R.read_manifests(spark, str(tmp_path / "*" / "*.manifest.json")).first()
    assert (m.site_id, m.tanggal, m.dokumen, m.vektor, m.push) == ("situs-a", "2026-01-02", 2, 0, "-")
    c = R.line_counts(spark, str(tmp_path / "*" / "*.jsonl")).first()
    assert c.baris == 2 and c.bytes == 4


def test_site_catalog(spark, tmp_path):
    p = tmp_path / "sites.json"
    sites = {"defaults": {"chunk_size": 3000, "duplicate_similarity": 0.9}, "sites": [
        "catatan", {"url": "https://www.a.go.id/x"}, {"url": "https://www.a.go.id/y/z", "year": 2024, "documentType": "apbd"},
        {"url": "https://www.a.go.id/q/z"}, {"name": "Nama Situs", "start_urls": [" https://b.id/ ", ""], "chunkSize": 10}, {"id": "kosong"}]}
    p.write_text("﻿" + json.dumps(sites))
    rows = R.site_catalog(spark, str(p)).orderBy("pos").collect()
    assert [r.id for r in rows] == ["www-a-go-id", "www-a-go-id-z", "www-a-go-id-3", "nama-situs"]
    assert [r.name for r in rows] == ["a.go.id", "APBD 2024", "a.go.id", "Nama Situs"]
    assert [r.chunk_size for r in rows] == [3000, 3000, 3000, 10]
    assert rows[3].start_urls == ["https://b.id/"] and rows[0].duplicate_similarity == 0.9


def test_fetch_retries_and_embedding_batches(spark):
    def get(u):
        if u.endswith("/sibuk"):
            return {"http_status": 503, "error": "sibuk"}
        return {"http_status": 200, "content_type": "text/html", "body": u.encode()}

    urls = spark.createDataFrame([("https://h/a",), ("https://h/sibuk",)], "url string")
    got = {r.url: (r.http_status, r.attempts) for r in S.fetch(urls, "url", get, retries=2).collect()}
    assert got == {"https://h/a": (200, 1), "https://h/sibuk": (503, 2)}

    def model(texts):
        assert len(texts) <= 2
        return [[float(len(t))] for t in texts] if "tolak" not in texts else []

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bb", "ccc", "tolak", "dd"])], "i long, t string").coalesce(1)
    got = [r.embedding for r in S.add_vectors(df, "t", model, 2, 100).orderBy("i").collect()]
    assert got == [[1.0], [2.0], None, None, [2.0]]
    r = spark.range(1).select(S.backoff_ms(F.lit(100), F.lit(3)).alias("b"), S.is_transient(F.lit(0), F.lit("x")).alias("t")).first()
    assert r.b == 400 and r.t


@pytest.fixture(scope="module")
def records(spark, sf):
    o = I.IngestOptions(chunk=ChunkOptions(size=1000, overlap=100))
    return I.ingest(table(spark, sf, "pages"), o).cache()


def test_ingest_records(records):
    from docloom.operators.chunk import PAYLOAD

    assert records.columns == PAYLOAD + ["embedding"]
    r = records.groupBy("document_id").agg(F.count("*").alias("n"), F.max("chunk_no").alias("m")).collect()
    assert r and all(x.n == x.m + 1 for x in r)
    assert records.select("chunk_id").distinct().count() == records.count()
    assert records.filter(F.length("content") < 50).isEmpty()


def test_point_exports(spark, records, tmp_path):
    pts = I.points(records)
    n = WR.write_point_file(pts, str(tmp_path / "satu"), "dokumen")
    text = "".join(r.value + "\n" for r in spark.read.text(str(tmp_path / "satu")).collect())
    doc = json.loads(text)
    assert doc["collection_name"] == "dokumen" and len(doc["points"]) == n == records.count()
    with pytest.raises(ValueError):
        WR.write_point_file(pts, str(tmp_path / "dua"), "dokumen", 1)
    b = WR.point_batches(pts, [F.col("id")], 10).collect()
    assert sum(x.n for x in b) == n and max(x.n for x in b) <= 10
    assert len(json.loads(b[0].value)["points"]) == b[0].n

    def put(value):
        if json.loads(value)["points"][0]["id"] == first:
            raise RuntimeError("penuh")

    first = min(r.id for r in pts.select("id").collect())
    sent = WR.upload_points(WR.point_batches(pts, [F.col("id")], 10), put, 2, 0).collect()
    assert sum(not s.ok for s in sent) == 1


def test_record_round_trip(spark, records, tmp_path):
    WR.append_records(records.withColumn("site_id", F.col("source")).withColumn("run_id", F.lit("R")), str(tmp_path / "v"))
    back = R.read_points(spark, str(tmp_path / "v" / "*" / "*"))
    assert back.filter("masalah is not null").isEmpty()
    assert back.select("point_id").distinct().count() == records.count()


def test_stream_matches_batch(spark, sf):
    from docloom.plans.derived import log_lines
    from docloom.plans.flow_queries import stream_live_counts

    want = {tuple(r) for r in live.live_counts(log_lines(spark, sf)).collect()}
    assert {tuple(r) for r in stream_live_counts(spark, sf).collect()} == want


def test_markdown_header(spark):
    c = WR.markdown_text(F.lit("https://h/"), F.lit(""), F.lit("isi"), F.lit("2026-01-01 00:00:00"), {"situs": F.lit("a"), "kota": F.lit("")})
    assert spark.range(1).select(c.alias("x")).first().x == (
        "# https://h/\n\n- sumber: https://h/\n- diparse: 2026-01-01 00:00:00\n- situs: a\n\n---\n\nisi\n"
    )
