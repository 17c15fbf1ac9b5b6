"""Streaming forms of the run reports and of exact duplicate removal."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import logs as L
from docloom.functions.ids import content_sha1
from docloom.session import ensure_checkpoint_dir


def live_counts(lines: DataFrame) -> DataFrame:
    """Per run: lines, documents, vectors and the end mark, as far as the log has been read."""
    v = F.col("value")
    ok = v.contains("[DOC_AFTER]") & v.contains("status=SUKSES")
    return lines.groupBy(L.line_part("value", 2).alias("run_id")).agg(
        F.count("*").alias("baris"),
        F.count_if(ok).alias("dokumen"),
        F.coalesce(F.sum(F.when(ok, L.line_number("value", "vektor"))), F.lit(0)).alias("vektor"),
        F.bool_or(v.contains("[RUN_END]")).alias("selesai"),
    )


def activity_sessions(events: DataFrame, site: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """Sessions that end after the activity timeout without an event."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.col(site), F.session_window(ts, f"{K.RUN_ACTIVE_SECONDS} seconds").alias("s"))
        .agg(F.count("*").alias("kejadian"))
    )


def first_seen_texts(docs: DataFrame, site: str, text: str, ts: str | None = None, keep: str | None = None) -> DataFrame:
    """Documents whose text is new for their site.

    State holds one hash per distinct text, partitioned by (site, hash): the copies of a hot
    text meet one key but keep no rows.  With an event time ``ts`` a hash is forgotten ``keep`` after the
    watermark has passed it; without one it is kept for good.
    """
    d = docs.withColumn("fingerprint", content_sha1(text))
    if ts is None:
        return d.dropDuplicates([site, "fingerprint"])
    return d.withWatermark(ts, keep).dropDuplicatesWithinWatermark([site, "fingerprint"])


def _folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return os.path.join(spark.sparkContext.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


#: Keeps state in files of the executors and not on their heap; operators with several kinds of state need it.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_sizes(query) -> list[dict]:
    """Rows and bytes of state after each micro-batch, as the engine reports them."""
    return [
        {"batch": p["batchId"], "rows": sum(o["numRowsTotal"] for o in p["stateOperators"]), "bytes": sum(o["memoryUsedBytes"] for o in p["stateOperators"])}
        for p in query.recentProgress
    ]


def run_to_end(
    stream: DataFrame, mode: str, name: str, sizes: list | None = None, once: bool = False, settings: dict[str, str] | None = None
) -> DataFrame:
    """Process what the source holds now and return the rows.

    Complete mode overwrites its result with every batch, append mode adds files; both go to
    the shared checkpoint folder together with the query's own state.  ``sizes`` gets the size of the state
    after each micro-batch.  ``once``: one micro-batch; state that expires by the clock asks for another batch for ever.
    ``settings``: of the session, for this stream only.
    """
    spark = stream.sparkSession
    base = _folder(spark, name)
    out = os.path.join(base, "rows")
    writer = stream.writeStream.option("checkpointLocation", os.path.join(base, "state"))
    writer = writer.outputMode(mode).trigger(**({"once": True} if once else {"availableNow": True}))
    settings = {STATE_STORE: ROCKSDB, **(settings or {})}  # read while the query is planned
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        if mode == "complete":
            q = writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
        else:
            q = writer.format("parquet").option("path", out).start()
        q.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    if sizes is not None:
        sizes += state_sizes(q)
    return spark.read.schema(stream.schema).parquet(out)


def append_json(stream: DataFrame, path: str, state: str):
    """Append-only JSON lines from a stream; exactly once through the file sink's log."""
    return (
        stream.writeStream.format("json").option("path", path).option("checkpointLocation", state)
        .outputMode("append")
    )
