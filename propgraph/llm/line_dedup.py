"""Line deduplication across documents, as per-document keep bitmaps.

A line's key is the line with blanks stripped at both ends and A-Z
lower-cased. Keys of at least ``min_points`` code points lose all their lines
except in the smallest doc_id that holds them.

Only 128-bit key hashes travel: (hash, doc_id, position) rows are
range-partitioned on the hash with a secondary sort by document and position;
the first row of a hash is its owner and later documents' positions are
dropped. A key with more lines than a task's fair share is never sorted: its
owner comes from the map-side-combined aggregate that found it, and the list
of such keys (at most 4 x shuffle partitions rows) is broadcast.

The result is a sparse bitmap per document: ``keep`` holds (word, bits) for
every 64-line word with a dropped line; an absent word keeps all its lines.
Texts are cut only by ``apply_bitmaps``.

Cases: null or empty text is one empty line; a null doc_id counts as the
largest id; rows that repeat a doc_id count as one document for ownership,
each keeps its own bitmap (documents are told apart by doc_id and text hash);
a document whose lines all go keeps the empty text; an empty table gives an
empty result; clashing extra columns of the input pass through
``apply_bitmaps`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propgraph.llm.common import BLANKS, checkpointed, hot_keys, lower_ascii

MIN_POINTS = 10
#: Fewest lines of one key that bypass the sort.
SPLIT_LINES = 2048
_KEEP = "array<struct<word:int,bits:bigint>>"


def _lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n", -1)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def line_bitmaps(docs: DataFrame, min_points: int = MIN_POINTS,
                 split_lines: int = SPLIT_LINES) -> DataFrame:
    """(doc_id, text_hash, keep) of the documents that lose lines."""
    exploded = docs.select("doc_id", _text_hash().alias("text_hash"),
                           F.posexplode(_lines()).alias("pos", "line"))
    key = exploded.select("doc_id", "text_hash", "pos",
                          lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key"))
    # counted, sampled, sorted and matched with the hot keys: hashed only once
    rows = checkpointed(key.where(F.char_length("key") >= min_points)
                        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                                "doc_id", "text_hash", "pos"))
    # min ignores nulls, so a null doc_id owns a key only if no other holds it
    hot, _ = hot_keys(rows, ["h1", "h2"], F.min("doc_id").alias("owner"),
                      total=rows.count(), floor=split_lines)
    marked = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True)).drop("n")), ["h1", "h2"], "left")
    here = ["doc_id", "text_hash", "pos"]
    # the hot branch never leaves the map side
    foreign = ~F.col("doc_id").eqNullSafe(F.col("owner"))
    of_hot = marked.where("hot").where(foreign).select(*here)
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "pos")
    of_rest = (marked.where("hot IS NULL").select("h1", "h2", *here)
               .repartitionByRange("h1", "h2")
               .withColumn("owner", F.first("doc_id").over(order))
               .where(foreign).select(*here))
    word = (of_hot.unionByName(of_rest)
            .groupBy("doc_id", "text_hash", F.expr("CAST(pos DIV 64 AS INT)").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("drop")))
    return (word.groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_list(
                F.struct("word", F.bitwise_not("drop").alias("bits")))).cast(_KEEP).alias("keep")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut to the kept lines, plus ``n_lines`` and
    ``n_dropped`` (which replace columns of those names)."""
    b = bitmaps.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                       F.col("keep").alias("_keep"))
    joined = (docs.withColumn("_th", _text_hash())
              .join(b, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_hash")),
                    "left"))
    words = F.expr("map_from_entries(_keep)")
    dense = F.transform(F.sequence(F.lit(0), F.expr("CAST((size(_lines) - 1) DIV 64 AS INT)")),
                        lambda w: F.coalesce(words[w], F.lit(-1).cast("long")))
    kept = F.expr("filter(_lines, (x, i) -> getbit(_dense[CAST(i DIV 64 AS INT)], i % 64) = 1)")
    cut = (joined.withColumn("_lines", _lines())
           .withColumn("_dense", F.when(F.col("_keep").isNotNull(), dense))
           .withColumn("_kept", F.when(F.col("_keep").isNotNull(), kept)))
    return cut.select(
        *[F.when(F.col("_kept").isNotNull(), F.array_join("_kept", "\n"))
          .otherwise(F.col("text")).alias("text") if c == "text" else F.col(c)
          for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_kept").isNotNull(), F.size("_lines") - F.size("_kept"))
        .otherwise(F.lit(0)).cast("long").alias("n_dropped"))
