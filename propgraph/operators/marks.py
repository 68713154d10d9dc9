"""Sets of keys as bits: the rows that can have a key of a set, told without a shuffle.

A key's place is a hash of it, and a set has a bit at every place of its keys. A row with its
bit set (``touched``) is one of the set or, now and then, another one; a row without
(``untouched``) is surely none of it. Rows of equal keys are on the same side, in whatever
table, so work that is right for more keys than those of the set gives the same result.

A set has ``KEY_BITS`` bits a key and at most ``MAX_BITS``, so it can be broadcast whatever
the number of keys: past that, more rows of other keys are touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.layers import write_table

KEY_BITS = 8
MAX_BITS = 1 << 27          # 16 MB a set

#: 64-bit words in a row of a written set.
WORDS = 32
ROW_BITS = 64 * WORDS


@dataclass(frozen=True)
class Marks:
    """A set: its rows (_block, _words), and how many bits it has (0: it is empty)."""
    rows: DataFrame | None
    bits: int


def key_hash(*cols: Column | str) -> Column:
    """The hash of a key that gives its place."""
    return F.xxhash64(*cols)


def write_marks(hashes: DataFrame, n_sets: int, path: str) -> list[Marks]:
    """The sets 0 to ``n_sets`` - 1 of ``hashes`` (set int, hash long), written at ``path``."""
    spark = hashes.sparkSession
    sizes = {r["set"]: r["n"] for r in hashes.groupBy("set").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    bits = [min(MAX_BITS, max(ROW_BITS, 1 << (KEY_BITS * sizes[i] - 1).bit_length())) if i in sizes else 0
            for i in range(n_sets)]
    mask = F.array(*[F.lit(max(0, b - 1)).cast("long") for b in bits])
    at = hashes.select("set", F.col("hash").bitwiseAND(mask[F.col("set")]).alias("at")).select(
        "set", F.shiftright("at", ROW_BITS.bit_length() - 1).alias("_block"),
        F.expr(f"shiftright(at, 6) & {WORDS - 1}").alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit"))
    words = [F.coalesce(F.bit_or(F.when(F.col("word") == i, F.col("bit"))), F.lit(0).cast("long")).alias(f"w{i}")
             for i in range(WORDS)]
    made = at.groupBy("set", "_block").agg(*words).select(
        "set", "_block", F.array(*[f"w{i}" for i in range(WORDS)]).alias("_words"))
    write_table(made.repartition("set"), path, by=["set"])
    read = spark.read.schema("_block long, _words array<bigint>")
    return [Marks(read.parquet(f"{path}/set={i}") if b else None, b) for i, b in enumerate(bits)]


def _told(df: DataFrame, marks: Marks, keys: tuple[Column | str, ...]) -> DataFrame:
    """``df`` with ``_hit``: whether the bit of the row's key is set."""
    placed = df.withColumn("_at", key_hash(*keys).bitwiseAND(F.lit(marks.bits - 1).cast("long")))
    joined = placed.join(F.broadcast(marks.rows), F.shiftright("_at", ROW_BITS.bit_length() - 1) == F.col("_block"), "left")
    hit = F.expr(f"getbit(_words[int(shiftright(_at, 6) & {WORDS - 1})], int(_at & 63)) = 1")
    return joined.select(*[joined[c] for c in df.columns], hit.alias("_hit"))


def touched(df: DataFrame, marks: Marks, *keys: Column | str) -> DataFrame:
    """The rows whose key can be in the set."""
    return _told(df, marks, keys).where("_hit").drop("_hit") if marks.bits else df.where(F.lit(False))


def untouched(df: DataFrame, marks: Marks, *keys: Column | str) -> DataFrame:
    """The other rows: their keys are not in the set."""
    return _told(df, marks, keys).where("NOT coalesce(_hit, false)").drop("_hit") if marks.bits else df
