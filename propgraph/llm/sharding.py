"""Sharding by rendezvous (highest random weight) hashing.

Every (record key, shard) pair gets a uniform number ``u`` from XXH64 of the
two; the record goes to the shard with the smallest ``-ln(u) / weight``. A
shard's share is proportional to its weight, and because a shard's number
depends on no other shard, adding a shard only takes records into it and
removing one only moves its own.

Cases: a null key hashes like an absent value (all null keys share a shard);
equal keys share a shard; null text counts as 0 bytes and CRC 0; an empty
table gives an empty result; extra columns of the input are not read, so they
cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import checkpointed

ROW_OVERHEAD = 8  # bytes counted per record besides its text


def rendezvous_shard(key: Column | str, shards: Sequence[tuple[int, float]]) -> Column:
    """The shard id of ``key`` among weighted ``shards`` (id, weight > 0);
    ties go to the smaller id."""
    if not shards or any(w <= 0 for _, w in shards) or len({i for i, _ in shards}) != len(shards):
        raise ValueError("shards need unique ids and positive weights")
    key = F.col(key) if isinstance(key, str) else key

    def race(s: Column) -> Column:
        h = F.xxhash64(key, s["id"])
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(2.0 ** 53)
        return F.struct((-F.ln(u) / s["w"]).alias("t"), s["id"].alias("id"))

    table = F.array(*[F.struct(F.lit(int(i)).alias("id"), F.lit(float(w)).alias("w"))
                      for i, w in shards])
    return F.array_min(F.transform(table, race))["id"]


def slots(rows: DataFrame, shard: str, order: str) -> DataFrame:
    """``rows`` plus ``slot``: 0, 1, 2, ... within each ``shard``, by ``order``.

    No task ever holds a whole shard: rows are range-partitioned on
    (shard, order, a row tie) and sorted, then a row's slot is its index in
    the partition minus its run's start plus the run's offset. There are at
    most ``partitions + shards`` runs, which bounds the broadcast.
    """
    fixed = checkpointed(rows.withColumn("_tie", F.monotonically_increasing_id())
                         .repartitionByRange(shard, F.col(order).asc_nulls_last(), "_tie")
                         .sortWithinPartitions(shard, F.col(order).asc_nulls_last(), "_tie")
                         .drop("_tie"))
    placed = (fixed.withColumn("_p", F.spark_partition_id())
              .withColumn("_i", F.monotonically_increasing_id()))
    runs = placed.groupBy("_p", shard).agg(F.min("_i").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("_p", shard, "_from",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(starts), ["_p", shard])
            .withColumn("slot", F.col("_i") - F.col("_from") + F.col("_before"))
            .drop("_p", "_i", "_from", "_before"))


def shard_documents(docs: DataFrame, shards: Sequence[tuple[int, float]],
                    grown: Sequence[tuple[int, float]] | None = None) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes + 8), text_crc32,
    shard, slot and, with ``grown`` given, the shard under that table."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous_shard("doc_id", shards).alias("shard"),
        (rendezvous_shard("doc_id", grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    return slots(rows, "shard", "doc_id")
