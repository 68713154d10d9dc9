"""Sets of keys as bits, the updates made with them, and what a write leaves on disk."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from propgraph.functions import key_id
from propgraph.operators import extract_link, extract_node, marks as M
from propgraph.plans import incremental as I
from propgraph.plans.spec import package_registry_spec
from propgraph.sources import write_layer

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def made(spark, path, sets, n_sets):
    rows = [(i, k) for i, keys in sets.items() for k in keys]
    hashes = spark.createDataFrame(rows, "set int, k string").select("set", M.key_hash("k").alias("hash"))
    return M.write_marks(hashes, n_sets, str(path))


@pytest.mark.parametrize("most", [M.MAX_BITS, M.ROW_BITS])
def test_every_key_of_a_set_is_touched(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(M, "MAX_BITS", most)
    some = {f"k{i}" for i in range(0, 3000, 3)}
    full, empty, one = made(spark, tmp_path / "m", {0: [*some, *some], 2: ["k1"]}, 3)
    assert full.bits in (min(most, 8192), min(most, 16384)) and (empty.bits, one.bits) == (0, M.ROW_BITS)   # counted roughly
    df = spark.createDataFrame([(f"k{i}", i) for i in range(3000)] + [(None, -1)], "k string, v long")
    for m, keys in ((full, some), (empty, set()), (one, {"k1"})):
        hit, rest = ([tuple(r) for r in f(df, m, "k").collect()] for f in (M.touched, M.untouched))
        assert sorted(hit + rest, key=str) == sorted(map(tuple, df.collect()), key=str)
        assert keys <= {k for k, _ in hit} and not keys & {k for k, _ in rest}
    # a full set tells most other keys apart, one of too few bits touches more of them
    others = M.touched(df, full, "k").count() - len(some)
    assert others < 600 if most > M.ROW_BITS else others > 600


@pytest.mark.parametrize("bits", [M.MAX_BITS, M.ROW_BITS])
def test_rows_made_again_equal_those_of_a_full_build(spark, tmp_path, monkeypatch, bits):
    """Twins and several rows of a key; 2,048 bits touch many ids that did not change."""
    monkeypatch.setattr(M, "MAX_BITS", bits)
    spec = package_registry_spec()
    person = lambda i: (f"p{i % 400}", [None, "", f"n{i % 90}"][i % 3], f"e{i % 70}", f"e{i % 70}", "d", "org", "author")
    schema = "pkg_name string, person_name string, email_record string, email string, domain string, top_level_domain string, role string"
    before, after = [person(i) for i in range(900)], [person(i) for i in range(50, 1000)]
    changed = [r for r in (*before, *after) if (r in before) != (r in after)]
    old, new, rows = (spark.createDataFrame(r, schema) for r in (before, after, changed))
    for s, extract, id_ in ((spec.nodes["author"], extract_node, "node_id"), (spec.links["has_author"], extract_link, "link_id")):
        ids = I._ids(rows, s, 0, 1).select(F.col("sub").alias("set"), F.col("id").alias("hash"))
        m = M.write_marks(ids, 2, str(tmp_path / f"{id_}"))[0]
        kept = write_layer({"t": extract(old, s)}, str(tmp_path / f"old-{id_}"))["t"]
        got = I._again(kept, new, m, s)
        assert sorted(map(str, got.collect())) == sorted(map(str, extract(new, s).collect()))
        # rows that stay are not shuffled: one exchange on each side of the extraction's aggregate
        stays = M.untouched(kept, m, id_)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in stays and "Exchange hashpartitioning" not in stays
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


def test_a_write_leaves_no_shuffle_files_and_packs_ids(spark, tmp_path):
    files = lambda: set(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                        .getAllFiles().mkString("\n").split("\n"))
    before, kept = {f for f in files() if "shuffle_" in f}, spark.conf.get(KEY)
    df = spark.range(20000).select(key_id("id").alias("a"), (F.col("id") % 7).alias("b")).repartition(4, "b")
    write_layer({"x": df, "y": df.groupBy("a").count()}, str(tmp_path))
    assert spark.conf.get(KEY) == kept
    until = time.time() + 30
    while (left := {f for f in files() if "shuffle_" in f} - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    parts = [f"{tmp_path}/x/{f}" for f in os.listdir(tmp_path / "x") if f.startswith("part-")]
    assert sum(map(os.path.getsize, parts)) < 20 * 20000 and spark.read.parquet(*parts).count() == 20000
