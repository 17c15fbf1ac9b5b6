"""Job lineage: retry chains and attempt numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import checkpoint


def attempts(jobs: DataFrame, job: str, retry_of: str) -> DataFrame:
    """(job, akar, percobaan): first job of each chain and the position in it.

    Pointer doubling: every round each job jumps as far as it already reached, so a chain of
    n retries takes about log2(n) joins, each on unique job ids, and no chain is gathered in
    one task.
    """
    d = jobs.select(
        F.col(job).alias("job"),
        F.coalesce(F.col(retry_of), F.col(job)).alias("akar"),
        F.when(F.col(retry_of).isNull(), 0).otherwise(1).alias("langkah"),
    )
    d = checkpoint(d)
    for _ in range(64):  # 2**64 retries: more rounds would mean that links form a ring
        up = d.select(
            F.col("job").alias("akar"), F.col("akar").alias("__to"), F.col("langkah").alias("__n")
        )
        d = checkpoint(
            d.join(up, "akar", "left").select(
                "job",
                F.coalesce("__to", "akar").alias("akar"),
                (F.col("langkah") + F.coalesce("__n", F.lit(0))).alias("langkah"),
                (F.coalesce("__n", F.lit(0)) > 0).alias("__moved"),
            )
        )
        moved = not d.filter("__moved").isEmpty()
        d = d.drop("__moved")
        if not moved:
            return d.select("job", "akar", (F.col("langkah") + 1).alias("percobaan"))
    raise ValueError("retry links form a ring")
