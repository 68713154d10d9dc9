"""Corpus cleaning: toxicity, line deduplication, SimHash near-deduplication,
benchmark decontamination, SentencePiece encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared folder and hands it, read again,
to the next. Stages keep the columns of ``documents`` (extra ones too); the
last one adds the token columns and the decoded text. A stage judges everything
its predecessor kept.

Cases: rows of repeated doc_ids are judged by their own texts; the
near-duplicate stage keeps one row of a group, also of rows that share an id, are
equal throughout, or have none. Null texts and empty tables pass through. A column
of ``documents`` named like a token column comes back with underscores in front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm import decontaminate, line_dedup, piece, simhash, toxicity
from propgraph.llm.common import checkpointed
from propgraph.llm.queries import table, tokenizer_path
from propgraph.session import scratch_path

TOKENS = ("n_tokens", "ids", "begins", "ends", "decoded")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _rest): other columns as one, so no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*(rest or [F.lit(None).cast("int").alias("none")]))
                       .alias("_rest"))


def _unpacked(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.`{c}`").alias(c)
                         for c in names])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents the trained scorer calls toxic (score >= 0.5)."""
    scorer = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(_packed(docs), scorer, keep=("doc_id", "text", "_rest"))
    return _unpacked(scored.where("score < 0.5"), docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that an earlier document holds; n_chars follows the text."""
    cut = line_dedup.apply_bitmaps(_packed(docs), line_dedup.line_bitmaps(docs))
    out = _unpacked(cut, docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every near-duplicate component: the smallest doc_id's (null
    last), of that id's rows the one whose text has the smallest SHA-256 (null first).

    Rows, not ids, are compared: a row's key is its id and digests of the text and the
    other columns. Only rows that are equal throughout share a key; where kept ones do,
    one more shuffle, which starts with map-side aggregation, leaves one of each.
    """
    packed = _packed(docs)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.sha2("text", 256).alias("text"),
                   F.xxhash64(F.to_json("_rest")).alias("rest"))
    rows = packed.withColumn("_key", key)
    found = simhash.near_duplicates(rows.select(F.col("_key").alias("doc_id"), "text"), words=4, radius=4)
    leaders = checkpointed(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_key"))
                           .agg(F.count(F.lit(1)).alias("_copies")))
    if not leaders.where("_copies > 1").isEmpty():
        rows = rows.dropDuplicates(["_key"])
    return _unpacked(rows.join(leaders, "_key", "left_semi"), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    found = decontaminate.with_verdict(decontaminate.find_contamination(
        _packed(docs), table(spark, sf_dir, "benchmark"), keep=("doc_id", "text", "_rest")))
    return _unpacked(found.where("NOT contaminated"), docs.columns)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids, the byte span of every piece and the text decoded from the ids."""
    packed = _packed(docs).withColumn("_text", F.col("text"))
    coded = piece.encode_documents(packed, tokenizer_path(), TOKENS, keep=("doc_id", "_text", "_rest"))
    names, taken = [], {*docs.columns, *TOKENS}
    for c in docs.columns:
        name = c
        while c in TOKENS and name in taken:
            name = f"_{name}"
        taken.add(name)
        names.append(name)
    source = {"doc_id": F.col("doc_id"), "text": F.col("_text")}
    return coded.select(*[source.get(c, F.col(f"_rest.`{c}`")).alias(n) for c, n in zip(docs.columns, names)], *TOKENS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: No SQL expresses a trained network or the tokenizer: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
