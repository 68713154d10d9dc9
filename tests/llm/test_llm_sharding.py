"""Sharding against XXH64 and the rendezvous rule in plain Python."""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from propgraph.llm import sharding


def shard_of(key: int | None, shards: list[tuple[int, float]]) -> int:
    def race(i: int, w: float) -> tuple[float, int]:
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), seed)
        return -math.log(((h >> 11) + 0.5) / 2 ** 53) / w, i
    return min(race(i, w) for i, w in shards)[1]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard string, slot int, size string")


ROWS = [(i, "x" * (i % 7) + "é" * (i % 3), "a", 1, "b") for i in range(400)] + [
    (None, None, "a", 1, "b"), (None, "", "a", 1, "b"), (5, "again", "a", 1, "b"), (5, "again", "a", 1, "b"),
    (-9, "word " * 20000, "a", 1, "b")]


def test_shards_sizes_and_slots(spark):
    even = [(i, 1.0) for i in range(7)]
    got = sharding.shard_documents(docs(spark, ROWS), even[:6], even).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()),
                    shard_of(d, even[:6]), shard_of(d, even)) for d, t, *_ in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    for r in got:
        assert r.grown_shard in (r.shard, 6)
    for s in range(6):
        mine = sorted((r.slot, r.doc_id is None, r.doc_id or 0) for r in got if r.shard == s)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_weights_give_proportional_shares(spark):
    shares = Counter(r.s for r in spark.range(20000).select(
        sharding.rendezvous_shard("id", [(0, 1.0), (1, 3.0)]).alias("s")).collect())
    assert abs(shares[1] / 20000 - 0.75) < 0.015


def test_removing_a_shard_moves_only_its_rows(spark):
    four = [(i, 1.0 + i) for i in range(4)]
    rows = spark.range(3000).select(sharding.rendezvous_shard("id", four).alias("a"),
                                    sharding.rendezvous_shard("id", four[:3]).alias("b")).collect()
    assert all(r.a == r.b for r in rows if r.a != 3) and any(r.a == 3 for r in rows)


def test_empty_table_and_bad_shards(spark):
    assert sharding.shard_documents(docs(spark, []), [(0, 1.0)]).count() == 0
    for bad in ([], [(0, 0.0)], [(0, 1.0), (0, 1.0)]):
        with pytest.raises(ValueError):
            sharding.rendezvous_shard(F.lit(1), bad)
