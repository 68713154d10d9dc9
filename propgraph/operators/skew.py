"""Joins on a key that may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

#: Fewest rows of one key that count as hot.
HOT_FLOOR = 4096


def spread_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` join ``table`` (one row per ``key``), no task holding a hot key.

    A key is hot above ``max(HOT_FLOOR, rows / (4 x shuffle partitions))`` rows, so
    there are at most ``4 x shuffle partitions`` of them whatever the input: that
    bound lets their few ``table`` rows be broadcast. All other rows are
    shuffled. ``rows`` is read up to three times and should be on disk.
    """
    spark, total = rows.sparkSession, rows.count()
    if total <= HOT_FLOOR:
        return rows.join(table, key, how)
    share = max(HOT_FLOOR, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = reliable_checkpoint(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share).select(key))
    if hot.isEmpty():
        return rows.join(table, key, how)
    few = F.broadcast(hot)
    return (rows.join(few, key, "left_semi").join(F.broadcast(table.join(few, key, "left_semi")), key, how)
            .unionByName(rows.join(few, key, "left_anti").join(table, key, how)))
