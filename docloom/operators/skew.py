"""Order numbers and joins that do not put one hot key into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.session import stored


#: Rows of a slice at most, about: the number of slices follows the rows, not only the session's setting.
SLICE_ROWS = 2_000_000


def ordered_slices(
    df: DataFrame, keys: list[str], order: list[Column], slices: int | None = None, is_stored: bool = False
):
    """Range-partition by (keys, order) and name each row's slice.

    Slices are ordered, about equal in size, and split a hot key over many tasks.  The
    result is written, because slice numbers must not change when a task is retried.
    """
    # range bounds come from a sample, a pass of its own: what lies above runs once
    d = df if is_stored else stored(df, "slices-input")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = slices or max(least, math.ceil(d.count() / SLICE_ROWS))
    d = d.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    return stored(d.withColumn("__slice", F.spark_partition_id()), "slices")


def running_row_number(
    df: DataFrame, keys: list[str], order: list[Column], out: str, slices: int | None = None
) -> DataFrame:
    """row_number() per key in two levels: inside a slice, plus the rows of earlier slices.

    Only (key, slice) counts cross between slices; they are a tiny table next to the rows.
    """
    d = ordered_slices(df, keys, order, slices)
    local = W.partitionBy(*keys, "__slice").orderBy(*order)
    counts = d.groupBy(*keys, "__slice").agg(F.count("*").alias("__n"))
    before = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    d = d.withColumn("__local", F.row_number().over(local))
    return (
        d.join(offsets, keys + ["__slice"])
        .withColumn(out, (F.col("__local") + F.col("__before")).cast("long"))
        .drop("__local", "__before", "__slice")
    )


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, spread: int = 32):
    """First ``k`` rows per key in two rounds: per key and salt, then per key.

    The second round sees at most ``k * spread`` rows of any key.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    first = W.partitionBy(*keys, "__salt").orderBy(*order)
    second = W.partitionBy(*keys).orderBy(*order)
    d = df.withColumn("__salt", salt).withColumn("__r", F.row_number().over(first))
    d = d.filter(F.col("__r") <= k)
    d = d.withColumn("rn", F.row_number().over(second)).filter(F.col("rn") <= k)
    return d.drop("__salt", "__r")
