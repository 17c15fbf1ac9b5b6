"""Writers: vector records, markdown, manifests, point files, uploads, reports, logs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.text import col
from docloom.operators import vectors as V
from docloom.session import stored


def append_records(records: DataFrame, path: str) -> None:
    """Append vector records as JSON lines, one directory per site and run."""
    keys = [c for c in ["site_id", "run_id"] if c in records.columns]
    w = records.write.mode("append")
    (w.partitionBy(*keys) if keys else w).json(path)


def markdown_text(url, title, markdown, stamp, meta: dict[str, Column | str]) -> Column:
    """Header (title, source, time, extra fields) and body of a stored markdown file."""
    head = F.when(col(title) != "", col(title)).otherwise(col(url))
    extra = [
        F.when(F.coalesce(col(v).cast("string"), F.lit("")) != "", F.concat(F.lit(f"- {k}: "), col(v)))
        for k, v in meta.items()
    ]
    return F.concat_ws(
        "\n",
        F.concat(F.lit("# "), head), F.lit(""), F.concat(F.lit("- sumber: "), col(url)),
        F.concat(F.lit("- diparse: "), col(stamp)), *extra, F.lit(""), F.lit("---"), F.lit(""),
        F.concat(col(markdown), F.lit("\n")),
    )


def manifest_rows(records: DataFrame, run_id: str, stamp: str, embedder: str) -> DataFrame:
    """One manifest per site: documents, vectors and dimension of the stored records."""
    return records.groupBy("site_id").agg(
        F.lit(run_id).alias("run_id"),
        F.lit(stamp).alias("dibuat"),
        F.count_distinct("document_id").alias("dokumen"),
        F.count("*").alias("vektor"),
        F.max(F.size("embedding")).alias("dimensi"),
        F.lit(embedder).alias("embedder"),
    )


def write_manifests(manifests: DataFrame, path: str) -> None:
    manifests.write.mode("append").partitionBy("site_id").json(path)


def point_json(point_id, vector, payload) -> Column:
    return F.to_json(F.struct(col(point_id).alias("id"), col(vector).alias("vector"), col(payload).alias("payload")))


def write_point_file(
    points: DataFrame, path: str, collection: str, max_points: int = K.EXPORT_MAX_POINTS
) -> int:
    """All points as one JSON document; only for exports within ``max_points``.

    The file is one object, so one task writes it; the limit, checked first by an aggregate,
    keeps that bounded.  Larger exports use :func:`write_point_batches`.  Mixed dimensions and
    empty inputs raise before anything is written, and the committer makes the write atomic.
    """
    if not 0 < max_points <= K.EXPORT_MAX_POINTS:
        raise ValueError("a single file needs a limit; use write_point_batches for more")
    points = stored(points, "points")  # checked, counted and written: what makes them runs once
    V.require_one_dimension(points)
    n = points.count()
    if n > max_points:
        raise ValueError(f"{n} points, more than {max_points}: use write_point_batches")
    body = points.orderBy("id").select(F.to_json(F.struct("id", "vector", "payload")).alias("p"))
    doc = body.agg(F.array_join(F.collect_list("p"), ",\n").alias("p")).select(
        F.concat(
            F.lit('{"collection_name":' + json.dumps(collection) + ',"wait":true,"points":[\n'), "p", F.lit("\n]}"),
        ).alias("value")
    )
    doc.coalesce(1).write.mode("overwrite").text(path)
    return n


def point_batches(points: DataFrame, order: list[Column], size: int = K.UPSERT_BATCH) -> DataFrame:
    """(batch, n, value): one ``{"points":[...]}`` line per ``size`` points, in file order."""
    b = V.upload_batches(points, order, size)
    item = F.struct("__rn", F.to_json(F.struct("id", "vector", "payload")).alias("j"))
    g = b.groupBy("batch").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(item)).alias("x"))
    text = F.array_join(F.transform("x", lambda x: x["j"]), ",")
    return g.select("batch", "n", F.concat(F.lit('{"points":['), text, F.lit("]}")).alias("value"))


def write_point_batches(points: DataFrame, order: list[Column], path: str, size: int = K.UPSERT_BATCH) -> None:
    point_batches(points, order, size).sort("batch").select("value").write.mode("overwrite").text(path)


def upload_points(
    batches: DataFrame, put: Callable[[str], None], retries: int = 3, delay_ms: int = 1000
) -> DataFrame:
    """Send every batch line with ``put``; failures are counted, not raised.

    Point ids are deterministic, so a retried task overwrites what it already sent.
    """
    import pandas as pd

    def send(frames):
        for f in frames:
            rows = []
            for batch, n, value in zip(f["batch"], f["n"], f["value"]):
                ok, error = False, None
                for attempt in range(1, retries + 1):
                    try:
                        put(value)
                        ok, error = True, None
                        break
                    except Exception as e:  # any failure of the remote side counts
                        error = str(e)
                        if attempt < retries and delay_ms > 0:
                            time.sleep(delay_ms / 1000)
                rows.append((batch, n, ok, error))
            yield pd.DataFrame(rows, columns=["batch", "n", "ok", "galat"])

    return batches.select("batch", "n", "value").mapInPandas(
        send, "batch long, n long, ok boolean, galat string"
    )


def check_collection(info: dict | None, dimension: int, recreate: bool) -> str:
    """What to do with the target collection: ``create``, ``recreate`` or ``keep``."""
    if info is None:
        return "create"
    if recreate:
        return "recreate"
    if info.get("dimension") not in (None, dimension):
        raise ValueError(f"collection has dimension {info['dimension']}, records have {dimension}")
    return "keep"


def normalize_distance(name: str) -> str:
    for known in K.DISTANCES:
        if known.lower() == name.strip().lower():
            return known
    raise ValueError(f"unknown distance {name!r}; choose from {', '.join(K.DISTANCES)}")


def timeout_seconds(value, default: int = 120) -> int:
    """Seconds; values of 1000 and more are milliseconds; anything else is the default."""
    try:
        n = int(float(value))
    except (TypeError, ValueError):
        return default
    if n <= 0:
        return default
    return max(1, int(n / 1000 + 0.5)) if n >= 1000 else n


def write_csv_report(report: DataFrame, path: str) -> None:
    """Report rows and the total row, in order, as one small CSV (a row per day and site)."""
    is_total = (F.col("tanggal") == "TOTAL").cast("int")
    report.sort(is_total, F.desc("tanggal"), F.desc("site_id")).write.mode("overwrite").csv(path, header=True)


def write_log(lines: DataFrame, path: str) -> None:
    """Append log lines, one directory per day, run and site."""
    lines.write.mode("append").partitionBy("tanggal", "run_id", "site").text(path)


def write_catalog(sites: DataFrame, path: str) -> None:
    sites.write.mode("overwrite").json(path)


def expired(files: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """Files that retention no longer covers: an anti join, deletion is left to the caller."""
    return files.join(keep.select(key).distinct(), key, "left_anti")
