"""Exact deduplication by content sort.

Texts are equal when identical after deleting every blank. Rows are
range-partitioned on the normalised bytes by sampled splitters and sorted
there (externally, so memory is bounded); equal texts become neighbours, and
the window's group boundaries are full comparisons of neighbouring texts. The
splitters hold the leading characters and a hash of the text, never the whole
text: a sample of whole texts would outgrow the driver.

A text held by more rows than a task's fair share is split into pieces of
about that share: the sort key is then (text, piece). Rows are dealt to pieces by
their place in the input, which a scan of files repeats exactly. The pieces' first rows,
few by construction, are merged by a full comparison again. The list of split
texts has at most 4 x shuffle partitions rows, so it and the merge result are
broadcast.

Cases: null text counts as empty; all blank texts are equal to the empty one;
of equal texts the row with the most code points in the original stays, then
the smallest doc_id (null last), then one of the repeated rows; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import checkpointed, hot_keys

#: Fewest rows of one text that are split.
SPLIT_ROWS = 256
#: Leading code points of a text in the splitters, which pass through the driver.
LEAD_POINTS = 32


def exact_dedup(docs: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.regexp_replace(text, r"[\x20\x09-\x0D]+", "").alias("norm"),
                       F.char_length(text).alias("points"))
    # a 64-bit key is enough here: it only decides what to split
    hot, share = hot_keys(rows.select(F.xxhash64("norm").alias("hkey")), ["hkey"],
                          total=docs.count(), floor=split_rows)
    pieces = hot.select("hkey", F.ceil(F.col("n") / F.lit(share)).alias("pieces"))
    dealt = (rows.withColumn("hkey", F.xxhash64("norm"))
             .join(F.broadcast(pieces), "hkey", "left")
             .withColumn("hot", F.col("pieces").isNotNull())
             .withColumn("piece", F.coalesce(
                 F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("pieces")), F.lit(0)))
             .withColumn("lead", F.substring("norm", 1, LEAD_POINTS))
             .drop("pieces"))
    # lead and hkey follow from norm: they add nothing to the group, but keep the
    # sampled splitters short
    group = Window.partitionBy("lead", "hkey", "norm", "piece")
    order = group.orderBy(F.col("points").desc(), F.col("doc_id").asc_nulls_last())
    sorted_ = dealt.repartitionByRange("lead", "hkey", "piece").select(
        "doc_id", "norm", "points", "hot", "piece",
        F.row_number().over(order).alias("place"),
        F.first("doc_id").over(order).alias("first_id"),
        F.count(F.lit(1)).over(group).alias("n"))
    first = F.col("place") == 1
    slim = checkpointed(sorted_.select(
        "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "points", "hot",
        "piece", first.alias("first"), "first_id", "n",
        F.when(F.col("hot") & first, F.col("norm")).alias("norm")))
    best = F.min(F.struct((-F.col("points")).alias("less"), F.col("first_id").isNull().alias("no_id"),
                          "first_id", "piece"))
    merged = (slim.where("hot AND first").groupBy("norm", "text_sha256")
              .agg(best.alias("best"), F.sum("n").alias("total"))
              .select("text_sha256", "best", "total"))
    return (slim.drop("norm").join(F.broadcast(merged), "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("hot"), F.col("best.first_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("total", "n").cast("long").alias("group_size"),
        (F.col("first") & (~F.col("hot") | (F.col("piece") == F.col("best.piece")))).alias("kept"),
        "text_sha256"))
