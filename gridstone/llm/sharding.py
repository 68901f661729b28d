"""Sharding by weighted rendezvous hashing of a stable record key.

Every shard scores every key from the key and the shard's number alone; the
best score owns the key.  A further shard only adds one score, so a key either
stays where it is or moves into the new shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .state import n_parts


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard number (0 to len(weights)-1) that owns ``key``.

    Score of shard i: -weight / ln(u), u uniform in (0, 1) from a hash of key
    and i; a shard's share is its weight's.  A null key is a key like others.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive, one a shard")
    scores = []
    for i, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11).cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((F.lit(-float(w)) / F.ln(u)).alias("score"), F.lit(-i).alias("shard")))
    best = F.array_max(F.array(*scores)) if len(scores) > 1 else scores[0]
    return (-best["shard"]).cast("int")


def gapless(df: DataFrame, group: str, order: Sequence[str], name: str, lanes: int) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each ``group``, without one task per group.

    Rows of a group are dealt into ``lanes`` by a hash of ``order``; lanes are
    numbered apart and shifted by the sizes of the lanes before.
    """
    lane, shift = "__lane", "__shift"
    dealt = df.withColumn(lane, F.pmod(F.xxhash64(*order), F.lit(lanes)).cast("int"))
    sizes = dealt.groupBy(group, lane).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy(lane).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(group).alias("__g"), F.col(lane).alias("__l"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(shift))
    own = Window.partitionBy(group, lane).orderBy(*order)
    numbered = dealt.withColumn(name, F.row_number().over(own).cast("long") - 1)
    joined = numbered.join(sizes, F.col(group).eqNullSafe(F.col("__g")) & (F.col(lane) == F.col("__l")))
    return joined.withColumn(name, F.col(name) + F.col(shift)).drop(lane, shift, "__g", "__l")


def shard_documents(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", lanes: int | None = None) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard of each row.

    size: UTF-8 bytes plus 8 (a null text has none); law: always ``key``;
    slot: gapless from 0 in each shard; grown_shard: the shard if one more, of
    the mean weight, stood beside the others.  Equal keys share a shard, rows
    repeated whole get slots of their own, an empty table gives no rows, and
    other columns of ``docs`` are not read.  lanes: how many tasks number a
    shard's slots, by default as the bytes of the texts ask for.
    """
    lanes = lanes or n_parts(docs.sparkSession, docs.select(key, text), 64 << 20)
    more = [*weights, sum(weights) / len(weights)]
    rows = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), more).alias("grown_shard"),
    )
    out = gapless(rows, "shard", [key, "text_crc32", "size"], "slot", lanes)
    return out.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
