"""Queries over crawl status, run reports, logs and estimates."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import logs as L
from docloom.operators import estimate as E, report as R, status as ST
from docloom.operators.skew import top_per_key
from docloom.plans import derived as D
from docloom.plans.registry import query
from docloom.session import table

# --- status table ---------------------------------------------------------------

_UPSERT = f"""{D.STATUS_SQL}, {D.UPDATES_SQL},
u AS (SELECT url, arg_max(status, seq) AS status, arg_max(message, seq) AS message, arg_max(run_id, seq) AS run_id,
  arg_max(last_crawled, seq) AS last_crawled, arg_min(id, seq) AS id, arg_min(document_type, seq) AS document_type FROM updates GROUP BY 1),
merged AS (SELECT coalesce(e.url, u.url) AS url, CASE WHEN e.url IS NULL THEN u.id ELSE e.id END AS id,
  CASE WHEN e.url IS NULL THEN u.document_type ELSE e.document_type END AS document_type,
  CASE WHEN u.url IS NULL THEN e.status ELSE u.status END AS status, CASE WHEN u.url IS NULL THEN e.message ELSE u.message END AS message,
  CASE WHEN u.url IS NULL THEN e.run_id ELSE u.run_id END AS run_id,
  CASE WHEN u.url IS NULL THEN e.last_crawled ELSE u.last_crawled END AS last_crawled FROM existing e FULL JOIN u ON u.url = e.url)"""


def _merged(spark, sf):
    return ST.upsert_status(D.status_rows(spark, sf), D.status_updates(spark, sf), "seq")


@query("status_upsert", f"WITH {_UPSERT} SELECT * FROM merged")
def status_upsert(spark, sf):
    return _merged(spark, sf)


@query(
    "insert_ignore",
    f"""WITH {D.STATUS_SQL}, {D.UPDATES_SQL}, n AS (SELECT url, arg_min(id, seq) AS id, arg_min(document_type, seq) AS document_type,
      'discovered' AS status, arg_min(message, seq) AS message, '' AS run_id, arg_min(last_crawled, seq) AS last_crawled
      FROM updates WHERE url NOT IN (SELECT url FROM existing) GROUP BY 1)
    SELECT * FROM existing UNION ALL SELECT * FROM n""",
)
def insert_ignore(spark, sf):
    return ST.insert_ignore(D.status_rows(spark, sf), D.status_updates(spark, sf), "seq")


@query(
    "status_histogram",
    f"""WITH {_UPSERT} SELECT count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed_akses') AS failed_akses,
      count(*) FILTER (status = 'discovered') AS discovered, count(*) AS total FROM merged""",
)
def status_histogram(spark, sf):
    return ST.status_histogram(_merged(spark, sf))


@query(
    "latest_status_topk",
    f"WITH {_UPSERT} SELECT * FROM merged WHERE status = 'failed_akses' ORDER BY last_crawled DESC, id DESC LIMIT 50",
)
def latest_status_topk(spark, sf):
    return ST.latest(_merged(spark, sf), "failed_akses", 50)


@query(
    "skip_success_sites",
    f"""WITH {_UPSERT}, s AS (SELECT n_nationkey, n_name, 'https://' || lower(c_name) || '.example.com/' AS url FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 0)
    SELECT n_nationkey, n_name FROM s LEFT JOIN merged m ON m.url = s.url AND m.status = 'success'
    GROUP BY 1, 2 HAVING count(s.url) = 0 OR count(s.url) > count(m.url)""",
)
def skip_success_sites(spark, sf):
    """Sites are nations, their start URLs the solvent customers' addresses."""
    urls = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_nationkey").alias("n_nationkey"),
        F.concat(F.lit("https://"), F.lower("c_name"), F.lit(".example.com/")).alias("url"),
    )
    hist = _merged(spark, sf).filter(F.col("status") == "success").select("url")
    # one row per (site, start URL): the universally quantified anti join without arrays
    open_sites = urls.join(hist, "url", "left_anti").select("n_nationkey").distinct()
    seeded = urls.select("n_nationkey").distinct()
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return n.join(open_sites, "n_nationkey", "left_semi").unionByName(n.join(seeded, "n_nationkey", "left_anti"))


_OUTCOME = """c AS (SELECT o_custkey, count(*) AS diproses, count(*) FILTER (o_orderstatus = 'F') AS gagal,
  count(*) FILTER (o_orderstatus = 'P') AS parse_gagal, count(*) FILTER (o_orderstatus = 'O') AS unduh FROM orders GROUP BY 1)"""


@query(
    "site_counters",
    f"""WITH {_OUTCOME} SELECT *, CASE WHEN diproses > 0 AND diproses = gagal THEN 'failed_akses' ELSE 'success' END AS status_situs,
      CASE WHEN gagal = 0 AND parse_gagal = 0 THEN 'SUKSES' WHEN unduh > 0 THEN 'SUKSES_SEBAGIAN' ELSE 'GAGAL' END AS status_run FROM c""",
)
def site_counters(spark, sf):
    s = F.col("o_orderstatus")
    c = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("diproses"), F.count_if(s == "F").alias("gagal"),
        F.count_if(s == "P").alias("parse_gagal"), F.count_if(s == "O").alias("unduh"),
    )
    return c.withColumn("status_situs", ST.site_outcome(F.col("diproses"), F.col("gagal"))).withColumn(
        "status_run", ST.run_status(F.col("gagal"), F.col("parse_gagal"), F.col("unduh"))
    )


@query(
    "summary_rows",
    f"""WITH {_OUTCOME}, t AS (SELECT sum(diproses)::BIGINT AS a, sum(gagal)::BIGINT AS b, sum(parse_gagal)::BIGINT AS c, sum(unduh)::BIGINT AS d FROM c)
    SELECT 'URL masuk antrean' AS baris, a AS nilai FROM t UNION ALL SELECT 'URL gagal unduh', b FROM t
    UNION ALL SELECT 'Parse gagal', c FROM t UNION ALL SELECT 'URL diunduh OK', d FROM t""",
)
def summary_rows(spark, sf):
    s = F.col("o_orderstatus")
    t = table(spark, sf, "orders").agg(
        F.count("*").alias("URL masuk antrean"), F.count_if(s == "F").alias("URL gagal unduh"),
        F.count_if(s == "P").alias("Parse gagal"), F.count_if(s == "O").alias("URL diunduh OK"),
    )
    return t.unpivot([], t.columns, "baris", "nilai")


# --- reports ---------------------------------------------------------------------

_DAILY = f"""{D.MANIFEST_SQL}, daily AS (SELECT tanggal, site_id, min(site_name) AS site_name, count(*) AS run,
  sum(dokumen)::BIGINT AS dokumen, sum(chunk)::BIGINT AS chunk, sum(vektor)::BIGINT AS vektor,
  sum(push_terkirim)::BIGINT AS push_terkirim, sum(push_gagal)::BIGINT AS push_gagal FROM manifests GROUP BY 1, 2)"""


@query("daily_rollup", f"WITH {_DAILY} SELECT * FROM daily")
def daily_rollup(spark, sf):
    return R.daily_rollup(D.manifests(spark, sf))


@query(
    "date_range_rollup",
    f"WITH {_DAILY} SELECT * FROM daily WHERE tanggal >= '1996-01-01' AND tanggal <= '1997-06-30' AND site_id = 'situs-3'",
)
def date_range_rollup(spark, sf):
    m = R.in_range(D.manifests(spark, sf), "tanggal", "1996-01-01", "1997-06-30", "situs-3")
    return R.daily_rollup(m)


@query(
    "rollup_total",
    f"""WITH {_DAILY} SELECT sum(run)::BIGINT AS run, sum(dokumen)::BIGINT AS dokumen, sum(chunk)::BIGINT AS chunk,
      sum(vektor)::BIGINT AS vektor, sum(push_terkirim)::BIGINT AS push_terkirim FROM daily""",
)
def rollup_total(spark, sf):
    return R.grand_total(R.daily_rollup(D.manifests(spark, sf)))


@query(
    "csv_report",
    f"""WITH {_DAILY} SELECT tanggal, site_id, site_name AS nama_web, run, dokumen, chunk, vektor, push_terkirim FROM daily
    UNION ALL SELECT 'TOTAL', '', '', sum(run)::BIGINT, sum(dokumen)::BIGINT, sum(chunk)::BIGINT, sum(vektor)::BIGINT, sum(push_terkirim)::BIGINT FROM daily""",
)
def csv_report(spark, sf):
    return R.with_total_row(R.daily_rollup(D.manifests(spark, sf)))


@query(
    "run_details",
    f"""WITH {D.MANIFEST_SQL} SELECT tanggal, site_id, count(*) AS jumlah,
      string_agg(run_id || ':' || dokumen || ':' || chunk || ':' || vektor, ',' ORDER BY run_id, dokumen, chunk, vektor) AS detail FROM manifests GROUP BY 1, 2""",
)
def run_details(spark, sf):
    d = R.run_details(D.manifests(spark, sf))
    text = F.transform("detail", lambda r: F.concat_ws(":", r["run_id"], r["dokumen"], r["chunk"], r["vektor"]))
    return d.select("tanggal", "site_id", F.size("detail").alias("jumlah"), F.array_join(text, ",").alias("detail"))


def _stored(spark, sf):
    """Vector-file line counts: one line per view event, so some sites have only one side."""
    e = table(spark, sf, "events").filter(F.col("event_type") == "view")
    user = F.col("user_id").cast("string")
    return e.groupBy(
        F.concat(F.lit("RUN-"), F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000")).alias("run_id"),
        F.concat(F.lit("situs-"), user).alias("site"),
    ).agg(F.count("*").alias("baris"), F.min(F.concat(F.lit("berkas-"), user)).alias("host"))


_PER_SITE = f"""{D.LOG_SQL},
done AS (SELECT run_id, site, count(*) AS dokumen, sum(chunk)::BIGINT AS chunk, sum(vektor)::BIGINT AS vl, site || '.example.com' AS host
  FROM log WHERE stage = 'DOC_AFTER' AND status = 'SUKSES' GROUP BY 1, 2),
stored AS (SELECT 'RUN-' || strftime(ts, '%Y%m%d-%H') || '0000' AS run_id, 'situs-' || user_id AS site, count(*) AS baris,
  'berkas-' || user_id AS host FROM events WHERE event_type = 'view' GROUP BY 1, 2, user_id),
per AS (SELECT coalesce(d.run_id, s.run_id) AS run_id, coalesce(d.site, s.site) AS site, coalesce(d.host, s.host) AS host,
  coalesce(dokumen, 0) AS dokumen, CASE WHEN coalesce(chunk, 0) > 0 THEN chunk ELSE coalesce(baris, vl, 0) END AS chunk,
  coalesce(baris, vl, 0) AS vektor FROM done d FULL JOIN stored s ON s.run_id = d.run_id AND s.site = d.site)"""


@query("per_site_run", f"WITH {_PER_SITE} SELECT * FROM per")
def per_site_run(spark, sf):
    return R.per_site_run(D.log_lines(spark, sf), _stored(spark, sf))


@query(
    "log_documents",
    f"""WITH {D.LOG_SQL} SELECT run_id, status, url, 'd-' || pos AS document_id, 'Judul ' || pos AS judul, '' AS mode_parse,
      chunk, vektor, '' AS tahap FROM log WHERE stage = 'DOC_AFTER'""",
)
def log_documents(spark, sf):
    return R.documents(D.log_lines(spark, sf))


@query(
    "log_render",
    f"""WITH {D.LOG_SQL} SELECT pos, '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] [' || run_id || '] [' || site || '] [' || stage
      || '] status=' || status || ' url=' || url || ' document_id=d-' || pos || ' judul="Judul ' || pos || '" chunk=' || chunk
      || ' vektor=' || vektor || ' durasi=' || durasi || 's :: Tahap selesai ' || pos AS value FROM log""",
)
def log_render(spark, sf):
    return D.log_lines(spark, sf)


def _manifest_days(spark, sf):
    """Manifests known for half of the event runs, some by run and some only by day."""
    e = table(spark, sf, "events").filter(F.col("event_type") == "click")
    return e.select(
        F.concat(F.lit("situs-"), F.col("user_id").cast("string")).alias("site_id"),
        F.when(F.col("value") > 20, F.lit("")).otherwise(
            F.concat(F.lit("RUN-"), F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000"))
        ).alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("tanggal"),
    ).distinct()


@query(
    "manifest_fallback",
    f"""WITH {_PER_SITE}, m AS (SELECT DISTINCT 'situs-' || user_id AS site_id, CASE WHEN value > 20 THEN '' ELSE
        'RUN-' || strftime(ts, '%Y%m%d-%H') || '0000' END AS run_id, strftime(ts, '%Y-%m-%d') AS tanggal FROM events WHERE event_type = 'click')
    SELECT site AS site_id, run_id, substr(run_id, 5, 4) || '-' || substr(run_id, 9, 2) || '-' || substr(run_id, 11, 2) AS tanggal,
      CASE WHEN n_name IS NOT NULL THEN n_name WHEN host <> '' THEN host ELSE site END AS site_name, dokumen, chunk, vektor
    FROM per LEFT JOIN nation ON 'situs-' || n_nationkey = site
    WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.site_id = per.site AND m.run_id = per.run_id)
      AND NOT EXISTS (SELECT 1 FROM m WHERE m.site_id = per.site AND m.run_id = '' AND m.tanggal =
        substr(per.run_id, 5, 4) || '-' || substr(per.run_id, 9, 2) || '-' || substr(per.run_id, 11, 2))""",
)
def manifest_fallback(spark, sf):
    runs = R.per_site_run(D.log_lines(spark, sf), _stored(spark, sf)).withColumnRenamed("site", "site_id")
    runs = runs.withColumn("tanggal", L.run_date("run_id"))
    names = table(spark, sf, "nation").select(
        F.concat(F.lit("situs-"), F.col("n_nationkey").cast("string")).alias("site_id"), F.col("n_name").alias("nama")
    )
    days = _manifest_days(spark, sf)
    none = days.limit(0).withColumns({c: F.lit(0).cast("long") for c in R.COUNTS}).withColumn("site_name", F.lit(""))
    extra = R.without_manifest(runs, days)
    u = R.combined_runs(none, extra, names)
    return u.select("site_id", "run_id", "tanggal", "site_name", "dokumen", "chunk", "vektor")


@query(
    "manifest_union",
    f"""WITH {D.MANIFEST_SQL}, x AS (SELECT site_id, run_id, tanggal, site_name, dokumen, chunk, vektor FROM manifests WHERE site_id IN ('situs-1', 'situs-2', 'situs-3')),
    f AS (SELECT site_id, run_id, tanggal, dokumen, chunk, vektor FROM x WHERE dokumen % 2 = 0 UNION ALL SELECT 'situs-' || n_nationkey, 'RUN-baru', '2030-01-01', 1, 2, 3 FROM nation)
    SELECT * FROM x UNION ALL SELECT f.site_id, f.run_id, f.tanggal, CASE WHEN n_nationkey % 2 = 0 THEN n_name WHEN n_nationkey % 3 = 0 THEN 'host-' || n_nationkey ELSE f.site_id END,
      f.dokumen, f.chunk, f.vektor FROM f JOIN nation ON 'situs-' || n_nationkey = f.site_id
      WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.site_id = f.site_id AND x.run_id = f.run_id)
        AND NOT EXISTS (SELECT 1 FROM x WHERE x.site_id = f.site_id AND x.run_id = '' AND x.tanggal = f.tanggal)""",
)
def manifest_union(spark, sf):
    """Both sides of the union: manifest rows as they are, log rows only where no manifest covers them."""
    cols = ["site_id", "run_id", "tanggal", "dokumen", "chunk", "vektor"]
    x = D.manifests(spark, sf).filter(F.col("site_id").isin("situs-1", "situs-2", "situs-3")).select(*cols, "site_name", "push_terkirim", "push_gagal")
    n = table(spark, sf, "nation").select((F.col("n_nationkey")).alias("k"), "n_name")
    site = F.concat(F.lit("situs-"), F.col("k").cast("string"))
    new = n.select(site.alias("site_id"), F.lit("RUN-baru").alias("run_id"), F.lit("2030-01-01").alias("tanggal"), *[F.lit(i).cast("long").alias(c) for i, c in ((1, "dokumen"), (2, "chunk"), (3, "vektor"))])
    host = F.regexp_extract("site_id", "([0-9]+)$", 1)
    log = x.filter("dokumen % 2 = 0").select(*cols).unionByName(new).withColumn("host", F.when(host.cast("int") % 3 == 0, F.concat(F.lit("host-"), host)).otherwise(F.lit("")))
    names = n.select(site.alias("site_id"), F.when(F.col("k") % 2 == 0, F.col("n_name")).otherwise(F.lit("")).alias("nama"))
    return R.combined_runs(x, log, names).select("site_id", "run_id", "tanggal", "site_name", "dokumen", "chunk", "vektor")


@query(
    "run_detail_rows",
    f"""WITH {D.MANIFEST_SQL} SELECT tanggal, site_id, run_id, dokumen, row_number() OVER (PARTITION BY tanggal, site_id
      ORDER BY run_id, dokumen, chunk, vektor, push_terkirim, push_gagal) AS urutan FROM manifests""",
)
def run_detail_rows(spark, sf):
    return R.run_detail_rows(D.manifests(spark, sf)).select("tanggal", "site_id", "run_id", "dokumen", "urutan")


@query(
    "run_ids_union",
    f"""WITH {D.LOG_SQL}, n AS (SELECT run_id || '.txt' AS f FROM log UNION ALL SELECT run_id || '.jsonl' FROM log WHERE stage = 'DOC_AFTER'
      UNION ALL SELECT 'catatan-' || pos || '.txt' FROM log),
    r AS (SELECT DISTINCT regexp_replace(f, '[.](jsonl|txt)$', '') AS run_id FROM n)
    SELECT run_id, substr(run_id, 5, 4) || '-' || substr(run_id, 9, 2) || '-' || substr(run_id, 11, 2) AS tanggal,
      substr(run_id, 14, 2) || ':' || substr(run_id, 16, 2) || ':' || substr(run_id, 18, 2) AS jam
    FROM r WHERE regexp_matches(run_id, '^RUN-[0-9]{{8}}-[0-9]{{6}}$') AND substr(run_id, 5, 8) BETWEEN '20240105' AND '20240125'""",
)
def run_ids_union(spark, sf):
    lines = D.log_lines(spark, sf)
    run, stage = L.line_part("value", 2), L.line_part("value", 4)
    logs = lines.select(F.concat(run, F.lit(".txt")).alias("f"))
    files = lines.filter(stage == "DOC_AFTER").select(F.concat(run, F.lit(".jsonl")).alias("f"))
    other = lines.select(F.concat(F.lit("catatan-"), F.col("pos").cast("string"), F.lit(".txt")).alias("f"))
    ids = R.run_ids(logs.unionByName(files).unionByName(other), "f", "2024-01-05", "2024-01-25")
    return ids.withColumn("jam", L.run_time("run_id"))


@query(
    "live_progress",
    f"""WITH {D.LOG_SQL} SELECT run_id, count(*) FILTER (stage = 'DOC_AFTER') AS dokumen_log, bool_or(stage = 'RUN_END') AS selesai FROM log GROUP BY 1""",
)
def live_progress(spark, sf):
    return R.live_progress(D.log_lines(spark, sf))


@query(
    "run_active_gap",
    f"""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL {K.RUN_ACTIVE_SECONDS} SECOND THEN 0 ELSE 1 END AS baru, event_id FROM events),
    s AS (SELECT user_id, ts, sum(baru) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sesi FROM g)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS mulai, count(*) AS kejadian FROM s GROUP BY user_id, sesi""",
)
def run_active_gap(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts")
    g = R.activity_runs(e, "user_id", "ts")
    return g.select("user_id", F.date_format("mulai", "yyyy-MM-dd HH:mm:ss").alias("mulai"), "kejadian")


@query(
    "latest_run",
    f"WITH {D.LOG_SQL} SELECT site, max(run_id) AS run_id, arg_max(stage, pos) AS tahap FROM log GROUP BY 1",
)
def latest_run(spark, sf):
    v = D.log_lines(spark, sf)
    return v.groupBy(L.line_part("value", 3).alias("site")).agg(
        F.max(L.line_part("value", 2)).alias("run_id"), F.max_by(L.line_part("value", 4), "pos").alias("tahap")
    )


@query(
    "preferred_names",
    """SELECT coalesce(n_nationkey, c) AS id, coalesce(n_name, 'Pelanggan ' || c) AS nama FROM nation
    FULL JOIN (SELECT DISTINCT (c_custkey % 40)::INT AS c FROM customer) ON c = n_nationkey""",
)
def preferred_names(spark, sf):
    a = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nama"))
    k = (F.col("c_custkey") % 40).cast("int")
    b = table(spark, sf, "customer").select(k.alias("id"), F.concat(F.lit("Pelanggan "), k.cast("string")).alias("nama"))
    return R.preferred_names([a, b], "id", "nama")


@query(
    "file_inventory",
    """WITH f AS (SELECT o_custkey, o_orderkey, round(o_totalprice)::BIGINT AS b, o_orderdate AS t, o_orderstatus AS s FROM orders),
    g AS (SELECT 'situs-' || o_custkey AS site, 'RUN-' || strftime(t, '%Y%m') AS run_id, max(CASE WHEN s = 'O' THEN b END) AS jsonl_bytes,
      max(CASE WHEN s = 'F' THEN b END) AS ekspor_bytes, max(CASE WHEN s = 'P' THEN b END) AS manifest_bytes,
      max(CASE WHEN s = 'O' THEN t END) AS j, max(CASE WHEN s = 'F' THEN t END) AS e, max(t) AS m FROM f GROUP BY 1, 2)
    SELECT site, run_id, jsonl_bytes, ekspor_bytes, manifest_bytes, strftime(m, '%Y-%m-%d') AS ubah, coalesce(e < j, false) AS basi,
      j IS NOT NULL AND NOT coalesce(e >= j, false) AS perlu_ekspor FROM g""",
)
def file_inventory(spark, sf):
    o = table(spark, sf, "orders")
    tail = (
        F.when(F.col("o_orderstatus") == "O", F.lit(".jsonl"))
        .when(F.col("o_orderstatus") == "F", F.lit(".qdrant.json"))
        .otherwise(F.lit(".manifest.json"))
    )
    files = o.select(
        F.concat(F.lit("situs-"), F.col("o_custkey").cast("string")).alias("site"),
        F.concat(F.lit("RUN-"), F.date_format("o_orderdate", "yyyyMM"), tail).alias("name"),
        F.round("o_totalprice").cast("long").alias("bytes"), F.col("o_orderdate").alias("mtime"),
    )
    d = R.file_inventory(files)
    return d.withColumn("ubah", F.date_format("mtime", "yyyy-MM-dd")).drop("mtime")


# --- estimator -------------------------------------------------------------------


@query(
    "positive_mean",
    """SELECT CASE WHEN grouping(c_nationkey) = 1 THEN NULL ELSE c_nationkey END AS situs,
      round(coalesce(avg(CASE WHEN c_acctbal > 0 THEN c_acctbal END), 0), 4) AS rata, count(*) AS sampel
    FROM customer GROUP BY GROUPING SETS ((c_nationkey), ())""",
)
def positive_mean(spark, sf):
    c = table(spark, sf, "customer")
    return c.rollup(F.col("c_nationkey").alias("situs")).agg(
        F.round(E.positive_mean("c_acctbal"), 4).alias("rata"), F.count("*").alias("sampel")
    )


@query(
    "stage_sum",
    f"""WITH {D.LOG_SQL} SELECT run_id, stage, sum(durasi)::DOUBLE AS detik,
      sum(CASE WHEN stage = 'EMBED_BATCH' THEN vektor ELSE 1 END)::BIGINT AS satuan FROM log GROUP BY 1, 2""",
)
def stage_sum(spark, sf):
    d = E.stage_sums(D.log_lines(spark, sf), [L.line_part("value", 2).alias("run_id")])
    return d.withColumn("detik", F.col("detik").cast("double"))


@query(
    "modal_site",
    f"""WITH {D.LOG_SQL}, n AS (SELECT run_id, site, count(*) AS n, min(pos) AS p FROM log GROUP BY 1, 2)
    SELECT run_id, site FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, p) AS rn FROM n) WHERE rn = 1""",
)
def modal_site(spark, sf):
    v = D.log_lines(spark, sf).select("pos", L.line_part("value", 2).alias("run_id"), L.line_part("value", 3).alias("site"))
    return E.modal_site(v, "run_id", "site", "pos")


_FOLD = f"""{D.LOG_SQL},
r AS (SELECT run_id, arg_min(site, pos) AS site, coalesce(arg_max(epoch(date_trunc('second', ts)), pos) FILTER (stage = 'SITE_START'), arg_min(epoch(date_trunc('second', ts)), pos)) AS mulai,
  coalesce(arg_max(epoch(date_trunc('second', ts)), pos) FILTER (stage = 'RUN_END'), 0) AS akhir,
  count(*) FILTER (stage = 'FETCH_AFTER' AND status = 'SUKSES') AS unduh, count(*) FILTER (stage = 'DOC_AFTER' AND status = 'SUKSES') AS dokumen,
  coalesce(sum(vektor) FILTER (stage = 'EMBED_BATCH'), 0) AS vektor,
  coalesce(sum(durasi) FILTER (stage = 'PARSE_AFTER'), 0)::DOUBLE AS parse, count(*) FILTER (stage = 'PARSE_AFTER') AS parse_n,
  coalesce(sum(durasi) FILTER (stage = 'EMBED_BATCH'), 0)::DOUBLE AS vs,
  coalesce(sum(durasi) FILTER (stage = 'RENDER_AFTER'), 0)::DOUBLE AS render, count(*) FILTER (stage = 'RENDER_AFTER') AS render_n FROM log GROUP BY 1),
fold AS (SELECT run_id, site, greatest((akhir - mulai) - parse - vs - render, 0.0)::DOUBLE / unduh AS detik_unduh,
  CASE WHEN parse_n > 0 THEN parse / parse_n ELSE 0 END AS detik_parse, CASE WHEN vektor > 0 THEN vs / vektor ELSE 0 END AS detik_vektor,
  CASE WHEN render_n > 0 THEN render / render_n ELSE 0 END AS detik_render, vektor::DOUBLE / unduh AS vektor_per_url,
  dokumen::DOUBLE / unduh AS dokumen_per_url, render_n::DOUBLE / unduh AS porsi_render, unduh::DOUBLE AS halaman_per_run
  FROM r WHERE akhir > mulai AND unduh > 0)"""
_ROUND = ", ".join(f"round({m}, 9) AS {m}" for m in K.ESTIMATE_DEFAULTS)


@query("run_fold", f"WITH {_FOLD} SELECT run_id, site, {_ROUND} FROM fold")
def run_fold(spark, sf):
    d = E.run_fold(D.log_lines(spark, sf), "pos")
    return d.select("run_id", "site", *[F.round(m, 9).alias(m) for m in E.MEASURES])


_MEANS = ", ".join(f"coalesce(sum({m}::DECIMAL(28,9)) FILTER ({m} > 0)::DOUBLE / count(*) FILTER ({m} > 0), 0) AS {m}" for m in K.ESTIMATE_DEFAULTS)
_PICK = ", ".join(f"coalesce(o.{m}, g.{m}, {d}) AS {m}" for m, d in K.ESTIMATE_DEFAULTS.items())
_EST = f"""{_FOLD}, own AS (SELECT site, count(*) AS sampel, {_MEANS} FROM fold GROUP BY 1), g AS (SELECT {_MEANS} FROM fold),
p AS (SELECT 'situs-' || c_custkey AS site_id, c_name AS nama, o.site IS NOT NULL AS punya, coalesce(o.sampel, 0) AS sampel, {_PICK}
  FROM customer LEFT JOIN own o ON o.site = 'situs-' || c_custkey CROSS JOIN g),
h AS (SELECT *, greatest(50, round(halaman_per_run)::INT) AS halaman FROM p),
est AS (SELECT site_id, nama, halaman, round(halaman * dokumen_per_url)::INT AS dokumen, round(halaman * vektor_per_url)::INT AS vektor,
  halaman * detik_unduh AS detik_unduh, halaman * detik_parse AS detik_parse, halaman * porsi_render * detik_render AS detik_render,
  round(halaman * vektor_per_url)::INT * detik_vektor AS detik_vektor, sampel, CASE WHEN punya THEN 'riwayat site' ELSE 'riwayat global' END AS sumber FROM h)"""


@query(
    "calibration",
    f"""WITH {_FOLD}, a AS (SELECT site, {_MEANS}, count(*) AS sampel FROM fold GROUP BY 1
      UNION ALL SELECT NULL, {_MEANS}, count(*) FROM fold) SELECT site, {_ROUND}, sampel FROM a""",
)
def calibration(spark, sf):
    c = E.calibration(E.run_fold(D.log_lines(spark, sf), "pos"))
    return c.select("site", *[F.round(m, 9).alias(m) for m in E.MEASURES], "sampel")


@query(
    "estimate",
    f"""WITH {_EST} SELECT site_id, nama, halaman, dokumen, vektor, round(detik_unduh, 7) AS detik_unduh, round(detik_parse, 7) AS detik_parse,
      round(detik_render, 7) AS detik_render, round(detik_vektor, 7) AS detik_vektor, sampel, sumber,
      round(detik_unduh + detik_parse + detik_render + detik_vektor, 7) AS detik_total FROM est""",
)
def estimate(spark, sf):
    e = _estimate(spark, sf)
    return e.select(
        "site_id", "nama", "halaman", "dokumen", "vektor",
        *[F.round(c, 7).alias(c) for c in ["detik_unduh", "detik_parse", "detik_render", "detik_vektor", "detik_total"]],
        "sampel", "sumber",
    )


def _estimate(spark, sf):
    sites = table(spark, sf, "customer").select(
        F.concat(F.lit("situs-"), F.col("c_custkey").cast("string")).alias("site_id"), F.col("c_name").alias("nama")
    )
    return E.estimate(sites, E.calibration(E.run_fold(D.log_lines(spark, sf), "pos")))


@query(
    "estimate_total",
    f"""WITH {_EST} SELECT sum(halaman)::BIGINT AS halaman, sum(dokumen)::BIGINT AS dokumen, sum(vektor)::BIGINT AS vektor,
      round(sum((detik_unduh + detik_parse + detik_render + detik_vektor)::DECIMAL(28,6))::DOUBLE, 1) AS detik_total FROM est""",
)
def estimate_total(spark, sf):
    return _estimate(spark, sf).agg(
        F.sum("halaman").alias("halaman"), F.sum("dokumen").alias("dokumen"), F.sum("vektor").alias("vektor"),
        F.round(F.sum(F.col("detik_total").cast("decimal(28,6)")).cast("double"), 1).alias("detik_total"),
    )


@query(
    "calibration_fallback",
    f"""WITH {_FOLD} SELECT run_id, site FROM fold WHERE run_id < 'RUN-20240103-000000'
    UNION ALL SELECT run_id, site FROM fold WHERE run_id >= 'RUN-20240103-000000' AND (SELECT count(*) FROM fold WHERE run_id < 'RUN-20240103-000000') < 1000000""",
)
def calibration_fallback(spark, sf):
    """Per-run logs exist for the first days only; daily logs cover every run."""
    daily = E.run_fold(D.log_lines(spark, sf), "pos")
    own = daily.filter(F.col("run_id") < "RUN-20240103-000000")
    return E.with_daily_fallback(own, daily, 1000000).select("run_id", "site")


@query(
    "calibration_enough",
    f"""WITH {_FOLD} SELECT run_id, site FROM fold WHERE run_id < 'RUN-20240103-000000' AND (SELECT count(*) FROM fold WHERE run_id < 'RUN-20240103-000000') >= 3
    UNION ALL SELECT run_id, site FROM fold WHERE (SELECT count(*) FROM fold WHERE run_id < 'RUN-20240103-000000') < 3""",
)
def calibration_enough(spark, sf):
    """The other side of the fallback: enough runs of their own, so the daily logs are not read."""
    daily = E.run_fold(D.log_lines(spark, sf), "pos")
    own = daily.filter(F.col("run_id") < "RUN-20240103-000000")
    return E.with_daily_fallback(own, daily, 3).select("run_id", "site")


@query(
    "default_limit",
    """SELECT c_nationkey, CASE WHEN count(*) FILTER (c_acctbal < -900) > 0 THEN 100 ELSE max(floor(c_acctbal))::BIGINT END AS batas FROM customer GROUP BY 1""",
)
def default_limit(spark, sf):
    """Largest site limit of a group, unless one of its sites is unlimited."""
    unlimited = F.count_if(F.col("c_acctbal") < -900) > 0
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.when(unlimited, F.lit(100).cast("long")).otherwise(F.max(F.floor("c_acctbal"))).alias("batas")
    )


# --- jobs, newest and tail rows -----------------------------------------------------


@query(
    "newest_per_group",
    """SELECT user_id, event_id, rn FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 10""",
)
def newest_per_group(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return top_per_key(e, ["user_id"], [F.desc("ts"), F.desc("event_id")], 10).select("user_id", "event_id", "rn")


@query("tail_n", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 100")
def tail_n(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type").orderBy(F.desc("event_id")).limit(100)


@query(
    "job_state",
    """SELECT user_id, arg_max(event_type, event_id) AS status, count(*) AS langkah, arg_max(event_type, event_id) IN ('view', 'click') AS aktif,
      count(*) FILTER (event_type = 'error') AS gagal FROM events GROUP BY 1""",
)
def job_state(spark, sf):
    """Latest state of each job from its event history (jobs are users)."""
    e = table(spark, sf, "events")
    last = F.max_by("event_type", "event_id")
    return e.groupBy("user_id").agg(
        last.alias("status"), F.count("*").alias("langkah"), last.isin("view", "click").alias("aktif"),
        F.count_if(F.col("event_type") == "error").alias("gagal"),
    )


@query(
    "retry_chain",
    """WITH RECURSIVE j AS (SELECT o_orderkey AS job, o_custkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS dari FROM orders),
    c AS (SELECT job, job AS akar, 1 AS percobaan FROM j WHERE dari IS NULL
      UNION ALL SELECT j.job, c.akar, c.percobaan + 1 FROM j JOIN c ON j.dari = c.job)
    SELECT * FROM c""",
)
def retry_chain(spark, sf):
    """Root job and attempt number along retry links, by pointer doubling."""
    from docloom.operators.jobs import attempts

    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    jobs = o.select(F.col("o_orderkey").alias("job"), F.lag("o_orderkey").over(w).alias("dari"))
    return attempts(jobs, "job", "dari")
