"""Run reports: daily roll-up, totals, per-site runs and the fallback for missing manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.operators.skew import running_row_number
from docloom import constants as K
from docloom.functions import logs as L
from docloom.functions.urls import host

COUNTS = ["dokumen", "chunk", "vektor", "push_terkirim", "push_gagal"]


def in_range(df: DataFrame, date: str, since: str = "", until: str = "", site: str = "") -> DataFrame:
    """Lexicographic date bounds, empty means open; optional site."""
    if since:
        df = df.filter(F.col(date) >= since)
    if until:
        df = df.filter(F.col(date) <= until)
    if site:
        df = df.filter(F.col("site_id") == site)
    return df


def daily_rollup(runs: DataFrame) -> DataFrame:
    """(tanggal, site_id): runs and summed counts, newest first.

    ``runs`` has one row per run and site: tanggal, site_id, site_name, run_id and the counts.
    """
    return (
        runs.groupBy("tanggal", "site_id")
        .agg(
            F.min_by("site_name", "run_id").alias("site_name"),
            F.count("*").alias("run"),
            *[F.sum(c).alias(c) for c in COUNTS],
        )
        .orderBy(F.desc("tanggal"), F.desc("site_id"))
    )


def run_details(runs: DataFrame) -> DataFrame:
    """(tanggal, site_id, detail): the runs of each group as a sorted array.

    One entry per run of one site on one day: bounded by how often a site can be crawled.
    """
    entry = F.struct("run_id", "dibuat", "dokumen", "chunk", "vektor", "push")
    return runs.groupBy("tanggal", "site_id").agg(F.sort_array(F.collect_list(entry)).alias("detail"))


def run_detail_rows(runs: DataFrame) -> DataFrame:
    """The same detail as rows, (tanggal, site_id, urutan, run): numbered without collecting a group.

    Row numbers run in two levels over range slices, so a site with very many runs is no single task.
    """
    order = [F.col(c) for c in ("run_id", "dokumen", "chunk", "vektor", "push_terkirim", "push_gagal")]
    return running_row_number(runs, ["tanggal", "site_id"], order, "urutan")


def grand_total(daily: DataFrame) -> DataFrame:
    """One row of sums; failed pushes are not part of the total."""
    return daily.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["run", *[x for x in COUNTS if x != "push_gagal"]]]
    )


def with_total_row(daily: DataFrame) -> DataFrame:
    """Report rows plus the TOTAL row, with the eight columns of the CSV report."""
    cols = ["run", "dokumen", "chunk", "vektor", "push_terkirim"]
    body = daily.select("tanggal", "site_id", F.col("site_name").alias("nama_web"), *cols)
    total = body.agg(*[F.sum(c).alias(c) for c in cols]).select(
        F.lit("TOTAL").alias("tanggal"), F.lit("").alias("site_id"), F.lit("").alias("nama_web"), *cols
    )
    return body.unionByName(total)


def per_site_run(lines: DataFrame, stored: DataFrame) -> DataFrame:
    """(run_id, site): documents, chunks, vectors of runs from their logs and vector files.

    ``lines`` (value) are log lines; ``stored`` (run_id, site, baris, host) counts vector-file
    lines and wins over the log.  Without logged chunks the vector count stands in.
    """
    v = F.col("value")
    done = lines.filter(v.contains("[DOC_AFTER]") & v.contains("status=SUKSES"))
    done = done.select(
        L.line_part("value", 2).alias("run_id"),
        L.line_part("value", 3).alias("site"),
        L.line_number("value", "chunk").alias("chunk"),
        L.line_number("value", "vektor").alias("vektor"),
        host(L.line_field("value", "url")).alias("host"),
        F.col("value").alias("__v"),
    ).filter(F.col("site") != "")
    logged = done.groupBy("run_id", "site").agg(
        F.count("*").alias("dokumen"),
        F.sum(F.coalesce("chunk", F.lit(0))).alias("chunk"),
        F.sum(F.coalesce("vektor", F.lit(0))).alias("vektor_log"),
        F.min_by("host", "__v").alias("host_log"),
    )
    j = logged.join(stored, ["run_id", "site"], "full_outer")
    vectors = F.coalesce("baris", "vektor_log", F.lit(0))
    chunks = F.coalesce("chunk", F.lit(0))
    return j.select(
        "run_id",
        "site",
        F.coalesce("host_log", "host", F.lit("")).alias("host"),
        F.coalesce("dokumen", F.lit(0)).alias("dokumen"),
        F.when(chunks > 0, chunks).otherwise(vectors).alias("chunk"),
        vectors.alias("vektor"),
    )


def without_manifest(runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """Runs that no manifest covers: by site and run, or by site and day where it names no run.

    Both key sets come from all manifests, before any date or site filter.
    """
    by_run = manifests.select("site_id", "run_id").distinct()
    by_day = manifests.filter(F.col("run_id") == "").select("site_id", "tanggal").distinct()
    return runs.join(by_run, ["site_id", "run_id"], "left_anti").join(
        by_day, ["site_id", "tanggal"], "left_anti"
    )


def combined_runs(manifests: DataFrame, fallback: DataFrame, names: DataFrame) -> DataFrame:
    """Manifest rows plus uncovered log rows; names from the catalog, else host, else id."""
    extra = without_manifest(fallback, manifests).join(names, "site_id", "left")
    extra = extra.withColumn(
        "site_name",
        F.coalesce(F.nullif("nama", F.lit("")), F.nullif("host", F.lit("")), F.col("site_id")),
    ).drop("nama", "host")
    return manifests.unionByName(extra, allowMissingColumns=True).fillna(0, COUNTS)


def run_ids(names: DataFrame, name: str, since: str = "", until: str = "") -> DataFrame:
    """Well-formed run ids behind vector and log file names, in range, each once."""
    run = F.regexp_replace(F.col(name), r"\.(jsonl|txt)$", "")
    d = names.select(run.alias("run_id")).filter(L.is_run_id("run_id")).distinct()
    return in_range(d.withColumn("tanggal", L.run_date("run_id")), "tanggal", since, until)


def preferred_names(sources: list[DataFrame], key: str, value: str) -> DataFrame:
    """Union of (key, value) tables where earlier tables win."""
    ranked = [d.select(key, value, F.lit(i).alias("__p")) for i, d in enumerate(sources)]
    u = ranked[0]
    for d in ranked[1:]:
        u = u.unionByName(d)
    return u.groupBy(key).agg(F.min_by(value, F.struct("__p", value)).alias(value))


def documents(lines: DataFrame) -> DataFrame:
    """Document rows written by a run's log."""
    v = "value"
    d = lines.filter(F.col(v).contains("[DOC_AFTER]"))
    title, ident = L.line_field(v, "judul"), L.line_field(v, "document_id")
    return d.select(
        L.line_part(v, 2).alias("run_id"),
        F.regexp_extract(v, r"\[DOC_AFTER\] status=(\S+)", 1).alias("status"),
        F.regexp_extract(v, r"\[DOC_AFTER\] status=\S+\s+url=(\S*)", 1).alias("url"),
        ident.alias("document_id"),
        F.when(title != "", title).otherwise(ident).alias("judul"),
        L.line_field(v, "mode_parse").alias("mode_parse"),
        F.coalesce(L.line_number(v, "chunk"), F.lit(0)).alias("chunk"),
        F.coalesce(L.line_number(v, "vektor"), F.lit(0)).alias("vektor"),
        L.line_field(v, "tahap").alias("tahap"),
    ).filter(F.col("status") != "")


def live_progress(lines: DataFrame) -> DataFrame:
    """Per run: documents logged and whether the run has ended."""
    v = F.col("value")
    return lines.groupBy(L.line_part("value", 2).alias("run_id")).agg(
        F.count_if(v.contains("[DOC_AFTER]")).alias("dokumen_log"),
        F.bool_or(v.contains("[RUN_END]")).alias("selesai"),
    )


def is_active(last_seen: Column, now: Column) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(last_seen) < K.RUN_ACTIVE_SECONDS


def activity_runs(
    events: DataFrame, key: str, ts: str, gap: int = K.RUN_ACTIVE_SECONDS, slice_seconds: int = 600
) -> DataFrame:
    """(key, mulai, akhir, kejadian): stretches in which events follow within ``gap`` seconds.

    Two levels, so a key with a third of all events does not fill one task: stretches are
    built inside slices of time first, then the few stretches per slice are merged per key.
    """

    def merged(df, part):
        w = W.partitionBy(*part).orderBy("mulai", "akhir")
        reach = F.max("akhir").over(w.rowsBetween(W.unboundedPreceding, -1))
        fresh = (
            F.col("mulai").cast("timestamp").cast("double") - reach.cast("timestamp").cast("double") < gap
        )
        d = df.withColumn("__new", F.when(fresh, 0).otherwise(1))
        d = d.withColumn("__run", F.sum("__new").over(w))
        return d.groupBy(*part, "__run").agg(
            F.min("mulai").alias("mulai"), F.max("akhir").alias("akhir"), F.sum("kejadian").alias("kejadian")
        ).drop("__run")

    at = F.col(ts).cast("timestamp").cast("double")
    e = events.select(
        key, F.floor(at / slice_seconds).alias("__slice"), F.col(ts).alias("mulai"),
        F.col(ts).alias("akhir"), F.lit(1).alias("kejadian"),
    )
    return merged(merged(e, [key, "__slice"]).drop("__slice"), [key])


def file_inventory(files: DataFrame) -> DataFrame:
    """(site, run): vector file, export and manifest sizes, newest change, stale export flag.

    ``files`` has site, name, bytes, mtime.  An export older than its vector file is stale.
    """
    kinds = {"jsonl": r"\.jsonl$", "ekspor": r"\.qdrant\.json$", "manifest": r"\.manifest\.json$"}
    kind = F.lit(None).cast("string")
    run = F.col("name")
    for k, pattern in kinds.items():
        kind = F.when(F.col("name").rlike(pattern), F.lit(k)).otherwise(kind)
        run = F.regexp_replace(run, pattern, "")
    d = files.select("site", run.alias("run_id"), kind.alias("kind"), "bytes", "mtime")
    d = d.filter(F.col("kind").isNotNull())

    def pick(k, c):
        return F.max(F.when(F.col("kind") == k, F.col(c)))

    g = d.groupBy("site", "run_id").agg(
        *[pick(k, "bytes").alias(f"{k}_bytes") for k in kinds],
        pick("jsonl", "mtime").alias("__j"),
        pick("ekspor", "mtime").alias("__e"),
        F.max("mtime").alias("mtime"),
    )
    stale = F.coalesce(F.col("__e") < F.col("__j"), F.lit(False))
    fresh = F.coalesce(F.col("__e") >= F.col("__j"), F.lit(False))
    return g.withColumn("basi", stale).withColumn(
        "perlu_ekspor", F.col("__j").isNotNull() & ~fresh
    ).drop("__j", "__e")


#: Counters of a run, per site, with the label of the summary row that totals them.
COUNTERS = {
    "url_diproses": "URL masuk antrean", "url_dilewati": "URL dilewati", "gagal_unduh": "URL gagal unduh", "parse_service": "Parse via /parse",
    "parse_fallback": "Parse fallback lokal", "parse_gagal": "Parse gagal", "konten_api": "Konten via API situs", "render_js": "Halaman dirender (JS)",
    "render_gagal": "Render gagal", "dokumen_auto_gagal": "Penemuan dokumen gagal", "konten_duplikat": "Konten duplikat dilewati",
    "dokumen": "Dokumen tersimpan", "chunk": "Chunk dibentuk", "vektor": "Vektor berhasil", "vektor_gagal": "Vektor gagal", "byte": "Total byte HTML",
    "durasi": "Durasi",
}


def run_counters(events: DataFrame, site: str, kind: str, amount: str) -> DataFrame:
    """One row per site with all counters, from counted events (site, kind, amount).

    Sums are combined before the shuffle, so a hot site sends a row for each task.
    """
    sums = [F.coalesce(F.sum(F.when(F.col(kind) == c, F.col(amount))), F.lit(0)) for c in COUNTERS]
    cast = [F.round(s, 2).cast("double") if c == "durasi" else s.cast("long") for s, c in zip(sums, COUNTERS)]
    return events.groupBy(site).agg(*[s.alias(c) for s, c in zip(cast, COUNTERS)])


def summary_of(counters: DataFrame) -> DataFrame:
    """(baris, nilai): the number of sites, then the total of each counter."""
    total = counters.agg(F.count("*").cast("double").alias("Site diproses"), *[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(label) for c, label in COUNTERS.items()])
    return total.unpivot([], total.columns, "baris", "nilai")


def discovery_log(found: DataFrame, domain: str, candidates: DataFrame, stamp: str) -> DataFrame:
    """One log row per searched domain: sites found, hosts tried, and the sites as JSON.

    ``found`` has the domain and any details; a domain without a site has an empty list.
    """
    details = [c for c in found.columns if c != domain]
    sites = found.groupBy(domain).agg(F.sort_array(F.collect_list(F.struct(*details))).alias("situs"))
    tried = candidates.groupBy(domain).agg(F.count("*").alias("jumlah_kandidat"))
    d = tried.join(sites, domain, "left").withColumn("situs", F.coalesce("situs", F.array().cast(sites.schema["situs"].dataType)))
    log = F.to_json(F.struct(F.col(domain).alias("domain"), "situs"))
    return d.select(domain, F.size("situs").alias("jumlah_ditemukan"), "jumlah_kandidat", log.alias("log"), F.lit(stamp).alias("created_at"))
