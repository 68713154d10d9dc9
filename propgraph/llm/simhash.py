"""SimHash near-deduplication with BK-trees.

1. Fingerprints. A text's A-Z is lower-cased, words are split at blanks, and
   every shingle of ``words`` words (fewer words: the whole sequence) is hashed
   with XXH64, seed 42. A bit is 1 if set in over half of the hashes; no words
   give 0. Long texts are hashed in blocks, so memory is bounded.
2. Shards. Documents are grouped by fingerprint first (copies cost one row
   each and are never paired). Two fingerprints within ``radius`` bits agree on
   at least ``blocks - radius`` of ``blocks`` bit blocks, so every choice of
   that many blocks is one table whose shards are the fingerprints that agree
   on them: no link is lost and shards stay small.
3. BK-trees. A task streams its sorted shards; each becomes a BK-tree, children
   keyed by integer Hamming distance to the parent, and each fingerprint
   follows only edges within the radius. Subtrees already known to be one
   component with the query are skipped, so a dense shard of g near copies
   costs about g steps, not g squared, and a shard yields one (fingerprint,
   root) link per member, not pairs. A shard tree is kept by the task that owns
   the shard instead of being broadcast, since its size is not bounded by
   anything but ``split``: larger shards are cut into parts and every pair of
   parts is a tree of its own.
4. Components. Links are contracted by repeated minimum labels with pointer
   jumping, checkpointed each round.

Cases: null text has no words (fingerprint 0, linked like any other); equal
doc_ids and repeated rows give one result row each; null doc_ids rank last and
a component of only null ids has a null id; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import checkpointed, split_join, widened

SEED = 42
#: Shingles hashed at once.
BLOCK = 1 << 16
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)  # byte value -> its bits


# ----------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, words: int = 4) -> int:
    """The unsigned 64-bit SimHash of one text."""
    # bytes.lower and bytes.split treat exactly A-Z and [\x20\x09-\x0D]
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - k + 1], ends[k - 1:] - 1
    total, ones, digest = len(starts), np.zeros(64, np.int64), xxhash.xxh64_digest
    for at in range(0, total, BLOCK):
        spans = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())
        hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]),
                               np.uint8).reshape(-1, 8)
        for j in range(8):  # digests are big-endian: byte j holds bits 56-8j and up
            ones[56 - 8 * j:64 - 8 * j] += np.bincount(hashes[:, j], minlength=256) @ _BITS
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > total))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp): every document with its fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t.as_py(), words)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, widened([src.schema["doc_id"]], "fp bigint"))


# ----------------------------------------------------------------- BK-tree
class BKTree:
    """Distinct integers; children keyed by Hamming distance to the parent.

    ``link_all`` joins all members within ``radius`` bits into components
    (union-find over insertion order) and returns each member's root index.
    """

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            at, v = 0, values[i]
            while True:
                d = (values[at] ^ v).bit_count()
                nxt = self.children[at].get(d)
                if nxt is None:
                    self.children[at][d] = i
                    break
                at = nxt

    def within(self, v: int, radius: int) -> list[int]:
        """Indices of the members within ``radius`` bits of ``v``."""
        out, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ v).bit_count()
            if d <= radius:
                out.append(at)
            todo += [c for e, c in self.children[at].items() if d - radius <= e <= d + radius]
        return out

    def link_all(self, radius: int) -> list[int]:
        n = len(self.values)
        root = list(range(n))
        whole = [not c for c in self.children]  # subtree known to be one component

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        values, children = self.values, self.children
        for q in range(n):
            v, mine, todo = values[q], find(q), [0]
            seen = []
            while todo:
                at = todo.pop()
                if whole[at] and find(at) == mine:
                    continue  # nothing new below: all of it is linked already
                seen.append(at)
                d = (values[at] ^ v).bit_count()
                if d <= radius:
                    other = find(at)
                    if other != mine:
                        mine, other = min(mine, other), max(mine, other)
                        root[other] = mine
                todo += [c for e, c in children[at].items() if d - radius <= e <= d + radius]
            for at in reversed(seen):  # children before parents
                if not whole[at] and find(at) == mine:
                    whole[at] = all(whole[c] and find(c) == mine for c in children[at].values())
        return [find(i) for i in range(n)]


def _shard_links(radius: int):
    """Streams rows sorted by shard; a shard may span batches."""
    names = ["fp", "root"]

    def links(values: np.ndarray) -> pa.RecordBatch | None:
        values = np.unique(values)
        if len(values) < 2:
            return None
        roots = BKTree([int(x) & (2 ** 64 - 1) for x in values.tolist()]).link_all(radius)
        at = np.asarray(roots)
        moved = np.flatnonzero(at != np.arange(len(at)))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(values[moved]), pa.array(values[at[moved]])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            fps = b.column(3).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = [0, *cuts.tolist(), len(fps)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                key = tuple(keys[lo].tolist())
                if key != last and held:
                    if (out := links(np.concatenate(held))) is not None:
                        yield out
                    held = []
                last = key
                held.append(fps[lo:hi])
        if held and (out := links(np.concatenate(held))) is not None:
            yield out

    return run


def choose_blocks(n: int, radius: int, mean_shard: int = 32) -> int:
    """Fewest bit blocks whose shards hold ``mean_shard`` random fingerprints
    on average; two more than the radius at least."""
    for blocks in range(radius + 2, 2 * radius + 1):
        if n <= mean_shard << (64 // blocks * (blocks - radius)):
            return blocks
    return max(radius + 2, 2 * radius)


def _block_masks(blocks: int) -> list[int]:
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(cuts[:-1], cuts[1:])]


def fingerprint_links(distinct: DataFrame, radius: int = 4, n: int | None = None,
                      blocks: int | None = None, split: int = 100_000) -> DataFrame:
    """(fp, root): links whose components are those of "within ``radius`` bits"."""
    n = distinct.count() if n is None else n
    blocks = blocks or choose_blocks(n, radius)
    masks = _block_masks(blocks)
    tables = [sum(c) for c in combinations(masks, blocks - radius)]
    keyed = distinct.select(
        F.col("fp"),
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in tables]))
        .alias("tab", "key"))
    # shards over the memory bound: cut in parts, one tree for each pair of parts
    large = checkpointed(
        keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split)
        .select("tab", "key", F.ceil(F.col("n") / F.lit(split)).cast("int").alias("parts")))
    if large.isEmpty():
        dealt = keyed.withColumn("cut", F.lit(0))
    else:
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: (
            F.least(part, j) * F.col("parts") + F.greatest(part, j)).cast("int"))
        dealt = (keyed.join(large, ["tab", "key"], "left")
                 .withColumn("parts", F.coalesce("parts", F.lit(1)))
                 .select("tab", "key", F.explode(pairs).alias("cut"), "fp"))
    return (dealt.repartition("tab", "key", "cut").sortWithinPartitions("tab", "key", "cut")
            .select("tab", "key", "cut", "fp")
            .mapInArrow(_shard_links(radius), "fp bigint, root bigint").distinct())


# ----------------------------------------------------------------- components
def components(links: DataFrame, a: str = "fp", b: str = "root") -> DataFrame:
    """(node, label) of every linked node: label is the component's smallest node.

    Each round hangs every node under its smallest neighbour, links its other
    neighbours to that one, and jumps one pointer up; the number of rounds is
    logarithmic. A node starts with at most one neighbour per table; the node
    many others hang under is met by ``split_join``. Rounds are checkpointed.
    """
    edges = checkpointed(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                         .where("u != v").distinct())
    while True:
        low = checkpointed(edges.groupBy("u").agg(F.min("v").alias("v")))
        others = (edges.join(low.select("u", F.col("v").alias("m")), "u").where("v != m")
                  .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"),
                          F.lit(True).alias("moved")))
        up = low.select(F.col("u").alias("v"), F.col("v").alias("up"))
        jumped = (split_join(low, up, "v", low.count(), "left")
                  .select("u", F.coalesce("up", "v").alias("v"), F.col("up").isNotNull().alias("moved")))
        stars = checkpointed(jumped.unionByName(others)
                             .groupBy("u", "v").agg(F.max("moved").alias("moved")))
        if stars.where("moved").isEmpty():
            break
        edges = stars.select("u", "v")
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4,
                    blocks: int | None = None, split: int = 100_000) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    fps = checkpointed(fingerprints(docs, words))
    distinct = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"),
                                                  F.count(F.lit(1)).alias("n")))
    size = distinct.agg(F.count(F.lit(1)).alias("fps"), F.sum("n").alias("rows")).first()
    linked = components(fingerprint_links(distinct.select("fp"), radius, size["fps"], blocks, split))
    labelled = checkpointed(distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
                            .select("fp", "first_id", F.coalesce("label", "fp").alias("label")))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_fp = (split_join(labelled.select("fp", "label"), smallest, "label", size["fps"])
             .select("fp", "component_id"))
    return split_join(fps, of_fp, "fp", size["rows"] or 0).select(
        "doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
