"""Session settings, table loading and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # text rows are small in bytes and heavy in work: keep partitions for all cores
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64kb",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of earlier rounds go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # do not record a Python stack for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(cpus: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docloom")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Set to a number to deal the rows of every scanned table out to that many partitions.  For single
#: files of one row group, which are one split whatever the settings; unset, no scan is shuffled.
SCAN_PARTITIONS = "docloom.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    wished = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(wished)) if wished else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make one only where none is named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and cut the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to the shared folder as Parquet and read back: lineage ends, columns can be pruned.

    The folder is new for each call; it lies in ``spark.checkpoint.dir``, so every executor reaches it.
    ``codec``: of the files, where the session's is not meant.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` gave and that nothing reads any more."""
    context = df.sparkSession.sparkContext
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Shuffle files go when the query that wrote them has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files of a query go with its end; else they stay until the driver happens to collect its garbage.

    Only for work whose every result is written: a frame that is read twice would be worked out twice.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
