"""Calibration from run logs and the crawl-time estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import logs as L

MEASURES = list(K.ESTIMATE_DEFAULTS)


def positive_mean(c) -> Column:
    """Mean of the values above zero; 0.0 when there are none.

    Summed as decimals, so the result does not depend on the order rows arrive in.
    """
    v = F.col(c) if isinstance(c, str) else c
    total = F.sum(F.when(v > 0, v.cast("decimal(28,9)"))).cast("double")
    return F.coalesce(total / F.nullif(F.count_if(v > 0), F.lit(0)), F.lit(0.0))


def calibration(metrics: DataFrame, site: str = "site") -> DataFrame:
    """Per-site rows and one global row (site NULL) of positive means and sample counts."""
    return metrics.groupingSets([[F.col(site)], []], F.col(site)).agg(
        *[positive_mean(m).alias(m) for m in MEASURES], F.count("*").alias("sampel")
    )


def stage_sums(lines: DataFrame, by: list[Column]) -> DataFrame:
    """Seconds and units per stage; a unit is a line, or the logged vectors when embedding."""
    stage = L.line_part("value", 4)
    seconds = L.line_seconds("value")
    unit = F.when(stage == "EMBED_BATCH", F.coalesce(L.line_number("value", "vektor"), F.lit(1))).otherwise(1)
    d = lines.select(*by, stage.alias("stage"), seconds.alias("detik"), unit.alias("satuan"))
    names = [c for c in d.columns if c not in ("detik", "satuan")]
    return d.filter(F.col("detik").isNotNull()).groupBy(*names).agg(
        F.sum(F.col("detik").cast("decimal(18,3)")).alias("detik"), F.sum("satuan").alias("satuan")
    )


def modal_site(lines: DataFrame, run: str, site: str, pos: str) -> DataFrame:
    """Most frequent site of each run; the one seen first wins a tie."""
    n = lines.groupBy(run, site).agg(F.count("*").alias("n"), F.min(pos).alias("first"))
    return n.groupBy(run).agg(F.max_by(site, F.struct("n", -F.col("first"))).alias(site))


def run_fold(lines: DataFrame, pos: str) -> DataFrame:
    """Per-run metrics from daily log lines (value, ``pos`` = line order).

    First line names the site, the last start and the last end bound the run.  Every part is
    an aggregate that combines before the shuffle, so one huge run does not fill one task.
    """
    v = F.col("value")
    d = lines.select(
        F.col(pos).alias("pos"),
        L.line_part("value", 1).alias("ts"),
        L.line_part("value", 2).alias("run_id"),
        L.line_part("value", 3).alias("site"),
        L.line_part("value", 4).alias("stage"),
        v.contains("status=SUKSES").alias("ok"),
        L.line_number("value", "vektor").alias("vektor"),
        L.line_seconds("value").cast("decimal(18,3)").alias("detik"),
    ).filter(L.is_run_id("run_id"))
    at = F.unix_timestamp("ts", "yyyy-MM-dd HH:mm:ss")

    def stage(*names):
        return F.col("stage").isin(*names)

    def seconds(name):
        return F.coalesce(F.sum(F.when(stage(name), F.col("detik"))), F.lit(0)).cast("double")

    starts = stage("RUN_START", "SITE_START")
    timed = F.col("detik").isNotNull()
    g = d.groupBy("run_id").agg(
        F.min_by("site", "pos").alias("site"),
        F.coalesce(F.max_by(at, F.when(starts, F.col("pos"))), F.min_by(at, "pos")).alias("mulai"),
        F.coalesce(F.max_by(at, F.when(stage("RUN_END"), F.col("pos"))), F.lit(0)).alias("akhir"),
        F.count_if(stage("FETCH_AFTER") & F.col("ok")).alias("unduh"),
        F.count_if(stage("DOC_AFTER") & F.col("ok")).alias("dokumen"),
        F.coalesce(F.sum(F.when(stage("EMBED_BATCH"), F.col("vektor"))), F.lit(0)).alias("vektor"),
        seconds("PARSE_AFTER").alias("parse"),
        F.count_if(stage("PARSE_AFTER") & timed).alias("parse_n"),
        seconds("EMBED_BATCH").alias("vector_s"),
        F.coalesce(
            F.sum(F.when(stage("EMBED_BATCH") & timed, F.coalesce("vektor", F.lit(0)))), F.lit(0)
        ).alias("vector_n"),
        seconds("RENDER_AFTER").alias("render"),
        F.count_if(stage("RENDER_AFTER") & timed).alias("render_n"),
    )
    length = F.col("akhir") - F.col("mulai")
    g = g.filter((length > 0) & (F.col("unduh") > 0))
    return per_unit(g.withColumn("durasi", length.cast("double")))


def per_unit(g: DataFrame) -> DataFrame:
    """Ratios of one run: seconds per page, file, vector and render, and shares per page."""
    pages = F.greatest(F.col("unduh"), F.lit(1)).cast("double")

    def ratio(total, n):
        return F.when(F.col(n) > 0, F.col(total) / F.col(n)).otherwise(0.0)

    rest = F.greatest(
        F.col("durasi") - F.col("parse") - F.col("vector_s") - F.col("render"), F.lit(0.0)
    )
    return g.select(
        "run_id",
        "site",
        (rest / pages).alias("detik_unduh"),
        ratio("parse", "parse_n").alias("detik_parse"),
        ratio("vector_s", "vector_n").alias("detik_vektor"),
        ratio("render", "render_n").alias("detik_render"),
        (F.col("vektor") / pages).alias("vektor_per_url"),
        (F.col("dokumen") / pages).alias("dokumen_per_url"),
        (F.col("render_n") / pages).alias("porsi_render"),
        F.col("unduh").cast("double").alias("halaman_per_run"),
    )


def summary_metrics(texts: DataFrame, text: str, run: str) -> DataFrame:
    """Metrics of finished runs from the summary block of each run log (one text per run)."""
    def number(label):
        return F.coalesce(
            F.regexp_extract(text, label + r'\.+\s*:\s*"?([0-9.]+)', 1).try_cast("double"), F.lit(0.0)
        )

    total = F.coalesce(
        F.regexp_extract(text, r'Durasi total\.+\s*:\s*"[^"(]*\(([0-9.]+)s\)"', 1).try_cast("double"),
        F.lit(0.0),
    )
    d = texts.filter(F.col(text).contains("RINGKASAN")).select(
        F.col(run).alias("run_id"),
        total.alias("durasi"),
        number("URL diunduh OK").alias("unduh"),
        number("Vektor berhasil").alias("vektor"),
        number("Dokumen tersimpan").alias("dokumen"),
    )
    return d.filter(F.col("durasi") > 0)


def with_daily_fallback(runs: DataFrame, daily: DataFrame, enough: int = 3) -> DataFrame:
    """Per-run metrics, completed by daily-log runs when there are fewer than ``enough``.

    The count is a scalar subquery of the same plan, so nothing is decided on the driver.
    """
    few = runs.agg((F.count("*") < enough).alias("few"))
    extra = daily.join(runs.select("run_id"), "run_id", "left_anti")
    return runs.unionByName(extra.filter(few.scalar()))


def estimate(
    sites: DataFrame, calibrated: DataFrame, pages: int = 0, render_mode: str = "auto"
) -> DataFrame:
    """Expected pages, documents, vectors and seconds per site (site_id, nama).

    A site uses its own means, else the global row, else the fixed defaults.
    """
    own = calibrated.filter(F.col("site").isNotNull()).select(
        F.col("site").alias("site_id"), F.struct(*MEASURES).alias("own"), F.col("sampel")
    )
    overall = calibrated.filter(F.col("site").isNull() & (F.col("sampel") > 0)).select(
        F.struct(*MEASURES).alias("overall")
    )
    one = overall.agg(F.first("overall").alias("overall"))
    d = sites.join(own, "site_id", "left").withColumn("overall", one.scalar())
    for m, default in K.ESTIMATE_DEFAULTS.items():
        d = d.withColumn(f"__{m}", F.coalesce(F.col(f"own.{m}"), F.col(f"overall.{m}"), F.lit(default)))
    if pages > 0:
        n = F.lit(pages)
    else:
        n = F.greatest(F.lit(50), F.round("__halaman_per_run").cast("int"))
    d = d.withColumn("halaman", n.cast("int"))
    share = {"always": F.lit(1.0), "off": F.lit(0.0)}.get(render_mode, F.col("__porsi_render"))
    d = d.select(
        "site_id",
        "nama",
        "halaman",
        F.round(F.col("halaman") * F.col("__dokumen_per_url")).cast("int").alias("dokumen"),
        F.round(F.col("halaman") * F.col("__vektor_per_url")).cast("int").alias("vektor"),
        (F.col("halaman") * F.col("__detik_unduh")).alias("detik_unduh"),
        (F.col("halaman") * F.col("__detik_parse")).alias("detik_parse"),
        (F.col("halaman") * share * F.col("__detik_render")).alias("detik_render"),
        F.col("__detik_vektor"),
        F.coalesce("sampel", F.lit(0)).alias("sampel"),
        F.when(F.col("own").isNotNull(), F.lit("riwayat site")).otherwise(F.lit("riwayat global")).alias("sumber"),
    )
    d = d.withColumn("detik_vektor", F.col("vektor") * F.col("__detik_vektor")).drop("__detik_vektor")
    work = F.col("detik_unduh") + F.col("detik_parse") + F.col("detik_render")
    return d.withColumn("detik_total", work + F.col("detik_vektor")).withColumn(
        "detik_per_url", F.when(F.col("halaman") > 0, work / F.col("halaman")).otherwise(0.0)
    )
