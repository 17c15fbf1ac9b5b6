"""Mixing sources to target weights: whole blocks of words by Sainte-Lague apportionment.

DataFrame functions only.  Words are cut into equal blocks of about ``block`` words (a shard's words
divided by its whole number of blocks); targets say how many blocks each source gives.  Seats go to the highest quotients target / (2 k + 1), first among
sources, then among the shards of each source, so every quota is a whole number of blocks and they
add up.  A shard lays its documents in seeded order on a line and gives whole rounds of all its
blocks, then the blocks first in a second seeded order.

Highest quotients without listing all seats: quota and exact share differ by little, so seats below
a lower bound are given at once and only those near the share compete (``apportion``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.llm.common import SPACE, read, stored
from docloom.llm.registry import query


@dataclass(frozen=True)
class MixOptions:
    """``weights``: of the sources in code point order, null last, repeating; ``share``: of all words that
    the mix takes; ``repeats``: how often a word may be taken; ``block``: words of a block; ``shard``:
    words that one shard orders; ``seed``: of both orders."""

    weights: Sequence[int] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2
    block: int = 128
    shard: int = 1 << 19
    seed: int = 20


def n_words(text: Column) -> Column:
    """Words of a text: the pieces between white space, without the empty ones at its ends."""
    t = F.coalesce(text, F.lit(""))
    return (F.size(F.split(F.concat(F.lit(" "), t, F.lit(" ")), SPACE)) - 2).cast("long")


def source_targets(sizes: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """``source, source_size`` to the same with ``target``.

    Targets are ``min(repeats * size, level * weight)`` for the one level that uses up the whole share
    (all words times ``share``): sources sorted by ``size / weight`` fill up in that order, so the
    level follows from running sums.  There is a row for each source, no more.
    """
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in options.weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(options.weights))) + 1).cast("int"))
    d = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(options.repeats)))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(options.share)
    # the level if this source and all after it were not full
    d = d.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # a source is full if its cap lies under the level at its turn; the first that is not sets the level
    full = F.col("cap") <= F.col("level") * F.col("weight")
    d = d.withColumn("final", F.min(F.when(~full, F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("l")))).over(every)["l"])
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("weight")))
    return d.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def apportion(parties: DataFrame, within: list[str], key: Column, share: str, seats: Column, limit: Column) -> DataFrame:
    """Sainte-Lague: adds ``quota``; ``share`` is a party's exact share of ``seats``, ``limit`` its most seats.

    With n parties and shares that add up to the seats (to within one), the divisor that hands out all
    seats differs from 1 so little that a party's quota lies within ``share * n / (2 seats) + 2`` of its
    share.  Seats below that are given, those in the interval compete by quotient (2 k + 1 below); the
    intervals hold some five seats a party, so the window over them is as small as the party table.
    """
    g = W.partitionBy(*within) if within else W.partitionBy(F.lit(0))
    d = parties.withColumn("__n", F.count("*").over(g)).withColumn("__seats", seats)
    reach = F.ceil(F.col(share) * F.col("__n") / (2 * F.greatest(F.col("__seats"), F.lit(1)))) + 2
    d = d.withColumn("__limit", limit.cast("long")).withColumn("__low", F.least(F.greatest(F.floor(F.col(share)) - reach, F.lit(0)), F.col("__limit")).cast("long"))
    d = d.withColumn("__high", F.least(F.ceil(F.col(share)) + reach, F.col("__limit")).cast("long"))
    d = d.withColumn("__open", F.col("__seats") - F.sum("__low").over(g))
    tries = F.when(F.col("__high") > F.col("__low"), F.sequence(F.col("__low"), F.col("__high") - 1))
    bids = d.select("*", F.explode_outer(tries).alias("__k"))
    quotient = F.col(share) / (2 * F.col("__k") + 1)
    turn = F.row_number().over(g.orderBy(F.col("__k").isNull(), quotient.desc(), key))
    won = F.col("__k").isNotNull() & (turn <= F.col("__open"))
    bids = bids.withColumn("__won", won.cast("long"))
    out = bids.groupBy(*[c for c in d.columns]).agg(F.sum("__won").alias("__won"))
    return out.withColumn("quota", F.col("__low") + F.col("__won")).drop("__n", "__seats", "__limit", "__low", "__high", "__open", "__won")


def mix(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """``doc_id, source, mark, size, source_size, target, taken`` for each row of ``docs(doc_id, text, source)``.

    ``taken``: words of this row that the mix takes, repeats counted, at most ``repeats`` times its
    size.  A null text has size 0 and is never taken; null sources are one source, the last; rows
    with the same id are rows of their own, ordered by content; a null id is an id like any other.
    No rows give no rows.  The same rows give the same mix, however they are partitioned.
    """
    o = options
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text", F.lit(o.seed)).alias("mark"))
    rows = stored(rows, "mix-rows").withColumn("place", F.xxhash64("doc_id", "mark", F.lit(o.seed)))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, o)
    all_seats = F.round(F.sum("target").over(W.partitionBy(F.lit(0))) / o.block).cast("long")
    targets = targets.withColumn("share", F.col("target") / o.block).withColumn("of", F.col("source"))
    sources = apportion(
        targets.drop("source"), [], F.xxhash64("of", F.lit(o.seed)), "share", all_seats,
        (F.floor(F.col("source_size") / o.block) + 1) * o.repeats,
    ).select("of", "source_size", "target", F.col("quota").alias("source_quota"))
    sources = stored(sources, "mix-sources")
    # shards: as many as the source needs, by a hash of the row
    d = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    d = d.withColumn("shard", F.pmod(F.xxhash64("place", F.lit(o.seed + 1)), F.ceil(F.col("source_size") / o.shard).cast("long") + F.lit(1)))
    shards = d.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("source_quota").alias("source_quota"))
    # equal blocks of about the wished size; a shard without words has none
    whole = F.greatest(F.round(F.col("shard_size") / o.block), F.lit(1)).cast("long")
    shards = shards.withColumn("blocks", F.when(F.col("shard_size") > 0, whole).otherwise(F.lit(0)).cast("long"))
    shards = shards.withColumn("share", F.col("source_quota") * F.col("shard_size") / F.greatest(F.col("source_size"), F.lit(1)))
    shards = apportion(
        shards, ["source"], F.col("shard"), "share", F.col("source_quota"), F.col("blocks") * o.repeats,
    ).select(F.col("source").alias("s_source"), F.col("shard").alias("s_shard"), "shard_size", "blocks", "quota")
    # a document's words on the line of its shard, and the blocks they lie in
    line = W.partitionBy("source", "shard").orderBy("place", "doc_id", "mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.join(shards, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("shard") == F.col("s_shard"))).drop("s_source", "s_shard")
    d = stored(d.withColumn("last", F.sum("size").over(line)).withColumn("first", F.col("last") - F.col("size")), "mix-line")
    d = d.withColumn("rounds", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0))
    d = d.withColumn("more", F.col("quota") - F.col("rounds") * F.col("blocks"))
    # the block order of a shard needs its number of blocks only
    numbers = d.groupBy("source", "shard").agg(F.first("blocks").alias("blocks"), F.first("more").alias("more")).filter("more > 0")
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64("source", "shard", "b", F.lit(o.seed + 2)), "b")
    picked = numbers.select("source", "shard", "more", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    picked = picked.withColumn("r", F.row_number().over(order)).filter("r <= more")
    chosen = picked.groupBy("source", "shard").agg(F.sort_array(F.collect_list("b")).alias("chosen")).select(
        F.col("source").alias("c_source"), F.col("shard").alias("c_shard"), "chosen")
    d = d.join(chosen, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("shard") == F.col("c_shard")), "left")
    # block b holds the words from b * shard_size div blocks on; word x lies in block ceil((x + 1) * blocks / shard_size) - 1
    at = F.expr("sequence(((first + 1) * blocks + shard_size - 1) div shard_size - 1, (last * blocks + shard_size - 1) div shard_size - 1)")
    inside = F.expr("""aggregate(array_intersect(CASE WHEN size > 0 THEN at END, coalesce(chosen, cast(array() AS array<bigint>))), 0L,
        (acc, b) -> acc + least(last, ((b + 1) * shard_size) div blocks) - greatest(first, (b * shard_size) div blocks))""")
    d = d.withColumn("at", F.when(F.col("size") > 0, at))
    taken = F.when(F.col("size") > 0, F.col("rounds") * F.col("size") + F.coalesce(inside, F.lit(0))).otherwise(0).cast("long")
    return d.select("doc_id", "source", "mark", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``mix_size, mix_target, mix_taken`` added.

    Rows that are equal in id and text are taken alike, with the largest of their counts.
    """
    mark = F.xxhash64("text", F.lit(options.seed))
    taken = mix(docs, options).filter("taken > 0").groupBy(F.col("doc_id").alias("__m_id"), F.col("mark").alias("__m_mark")).agg(
        F.max("size").alias("mix_size"), F.max("target").alias("mix_target"), F.max("taken").alias("mix_taken"))
    return docs.join(taken, docs["doc_id"].eqNullSafe(taken["__m_id"]) & (mark == F.col("__m_mark"))).drop("__m_id", "__m_mark")


@query("op8_sainte_lague_mix")
def op8_sainte_lague_mix(spark, sf):
    return mix(read(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")
