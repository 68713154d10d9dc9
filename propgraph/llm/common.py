"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from propgraph.session import checkpoint_dir

#: The characters of ``[\x20\x09-\x0D]``, as text.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the shared checkpoint folder.

    Only ever called on narrow rows (ids, digests, fingerprints), never on
    texts. The files survive a lost executor; Spark's cleaner removes them
    with the frame when ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is on.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def widened(fields: list[StructField], ddl: str) -> StructType:
    """``fields`` and then the columns of ``ddl`` (names may hold anything)."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that on ASCII strings (the
    usual case, and quick); others go through ``translate``."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def hot_keys(rows: DataFrame, keys: list[str], *aggs: Column, total: int, floor: int) -> tuple[DataFrame, int]:
    """Keys with more of the ``total`` rows than a fair share of a task, and that share.

    One map-side-combined aggregate over ``rows``. The share is
    ``max(floor, total / (4 x shuffle partitions))``, so the result has at most
    ``4 x shuffle partitions`` rows whatever the input: that bound is what
    allows it to be broadcast. Columns: ``keys``, ``n``, then ``aggs``.
    """
    share = max(floor, total // (4 * shuffle_partitions(rows.sparkSession)))
    return checkpointed(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)
                        .where(F.col("n") > share)), share


def split_join(rows: DataFrame, table: DataFrame, key: str, total: int, how: str = "inner",
               floor: int = 256) -> DataFrame:
    """``rows`` join ``table`` (unique ``key``) with no task holding a hot key.

    Keys over a fair share of the ``total`` rows (at most 4 x shuffle
    partitions of them) meet a broadcast of their few ``table`` rows; the
    others are shuffled. ``rows`` should be checkpointed: it is read twice.
    """
    share = max(floor, total // (4 * shuffle_partitions(rows.sparkSession)))
    hot = checkpointed(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                       .where(F.col("_n") > share).select(key))
    if hot.isEmpty():
        return rows.join(table, key, how)
    few = F.broadcast(hot)
    return (rows.join(few, key, "left_semi")
            .join(F.broadcast(table.join(few, key, "left_semi")), key, how)
            .unionByName(rows.join(few, key, "left_anti").join(table, key, how)))
