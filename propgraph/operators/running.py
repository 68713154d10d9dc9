"""Rules that depend on input order, made explicit with an order column.

``null_first_occurrence``: NULL a value on the first row (in ``ord`` order)
that carries it, keep it on every later row.

``drop_first_occurrences``: drop the first ``k`` rows of every key (running
count within the key, in order, must exceed ``k``).

Neither window-partitions all rows by the value: one value may hold a third of
them, and a window over it would put them in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


#: Rows one bucket of ``drop_first_occurrences`` aims at.
BUCKET_ROWS = 1_000_000

#: Sets of input partitions ``kth_occurrence`` ranks apart.
SHARES = 64


def require_order(df: DataFrame, order: Sequence[str]) -> None:
    """Raise unless the ``order`` columns are never NULL and unique over the rows
    (one aggregate with map-side combine; at most one row reaches the driver)."""
    order = list(order)
    bad = (df.select(*order).groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
             .where((F.col("_n") > 1) | reduce(or_, [F.col(c).isNull() for c in order])).limit(1).collect())
    if bad:
        raise ValueError(f"order columns {order} must be unique and not NULL: {bad[0].asDict()}")


def null_first_occurrence(df: DataFrame, col: str, ord_col: str) -> DataFrame:
    """Per value of ``col``: min(ord) by partial aggregation, then a join back
    on (value, ord). ``ord`` must be unique and not NULL (``require_order``
    checks it), so that join key spreads a hot value over all partitions; AQE broadcasts the first-occurrence side when its
    measured size is small.
    """
    firsts = (df.where(F.col(col).isNotNull())
                .groupBy(col).agg(F.min(ord_col).alias(ord_col))
                .withColumn("_first", F.lit(True)))
    joined = df.join(firsts, on=[col, ord_col], how="left")
    return joined.select(*[
        F.when(F.col("_first"), F.lit(None)).otherwise(F.col(col)).alias(col)
        if c == col else F.col(c) for c in df.columns])


def kth_occurrence(df: DataFrame, key: str, order: Sequence[str], k: int) -> DataFrame:
    """(key, at) per key of at least ``k`` rows: ``at``, the ``order`` tuple of its k-th row.

    Bounded selection: a row can only be among the first ``k`` of its key if it is among
    the first ``k`` of its key within its input partition, and within any set of input
    partitions. Spark limits the groups of a ranking window before the shuffle, so at most
    ``k`` rows a key leave an input partition; ``SHARES`` sets of partitions are ranked
    apart, so a hot key's candidates meet in that many tasks, and a second ranking over
    at most ``SHARES * k`` rows a key finds the k-th. Which partition a row lies in does
    not change the result.
    """
    order = list(order)
    first = df.select(F.col(key).alias("_key"), *order).withColumn("_share", F.spark_partition_id() % SHARES)
    for part in (["_key", "_share"], ["_key"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        first = first.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return first.where(F.col("_rank") == k).select(F.col("_key").alias(key), F.struct(*order).alias("at"))


def drop_first_occurrences(df: DataFrame, key: str, order: Sequence[str], k: int,
                           n_buckets: int | None = None) -> DataFrame:
    """Keep a row only when its running count within ``key`` exceeds ``k``.

    ``order`` must be unique per row and not NULL (``require_order``). NULL is a key
    like any other.

    Without ``n_buckets`` the k-th row of every key is selected (``kth_occurrence``) and a
    join on the key keeps the rows after it: no row is checkpointed or sorted, a key is
    in the smaller side once, so adaptive execution broadcasts that side or splits a hot
    key's rows. ``df`` is read twice, so it had better be on disk.

    With ``n_buckets``, or where ``k`` is over the limit up to which Spark limits the
    groups of a window before the shuffle (``spark.sql.optimizer.windowGroupLimitThreshold``),
    rows go to ranges instead; without a given number, one per ``BUCKET_ROWS`` rows and
    one per shuffle partition at least. Exact and skew-proof too:

    1. range-partition rows on ``order`` into buckets and tag each row with its
       bucket; checkpoint the tagged rows, so a recomputed task cannot move a
       row;
    2. count rows per (key, bucket) with map-side combine;
    3. prefix-sum those counts per key over buckets (a key has at most
       ``n_buckets`` rows there);
    4. a bucket whose rows all lie before / after the k-th is dropped / kept
       whole; only the bucket where the k-th falls is ranked, by a window over
       (key, bucket), whose size is bounded by one bucket.
    """
    if k <= 0:
        return df                                   # every running count exceeds k
    order = list(order)
    spark = df.sparkSession
    if n_buckets is None and k <= int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        kth = kth_occurrence(df, key, order, k).select(F.col(key).alias("_dkey"), F.col("at").alias("_dat"))
        return (df.join(kth, df[key].eqNullSafe(kth["_dkey"]) & (F.struct(*[df[c] for c in order]) > kth["_dat"]))
                .select(*[df[c] for c in df.columns]))
    if n_buckets is None:
        df = reliable_checkpoint(df)        # counted, sampled and shuffled: computed once
        n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                        -(-df.count() // BUCKET_ROWS))
    tagged = (df.repartitionByRange(n_buckets, *order)
                .withColumn("_bucket", F.spark_partition_id()))
    tagged = reliable_checkpoint(tagged)

    counts = tagged.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(
        Window.partitionBy(key).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    decided = (counts.withColumn("_before", before)
                     .where(F.col("_before") + F.col("_n") > k)
                     .drop("_n"))

    # NULL is a key like any other for the running count: join NULL-safely
    # (still an equi-join on (key, bucket) in the plan).
    d = decided.select(F.col(key).alias("_dkey"), F.col("_bucket").alias("_dbucket"), "_before")
    rows = (tagged.join(d, tagged[key].eqNullSafe(d["_dkey"]) & (tagged["_bucket"] == d["_dbucket"]),
                        "inner")
                  .drop("_dkey", "_dbucket"))
    rank = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order))
    whole = rows.where(F.col("_before") >= k)
    split = (rows.where(F.col("_before") < k).withColumn("_rank", rank)
                 .where(F.col("_before") + F.col("_rank") > k))
    return whole.select(*df.columns).unionByName(split.select(*df.columns))
