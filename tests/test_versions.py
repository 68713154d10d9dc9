"""Versions of the layers: committed whole or not at all; metrics taken while writing."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propgraph import build_graph, package_registry_spec
from propgraph.operators import graph_catalog, table_digests, written_catalog
from propgraph.plans import graph as G
from propgraph.sources import (Fixtures, commit_version, commits, current_version, differing, drop_versions, new_version,
                               read_graph, read_metrics)

SF = "/root/testdata/sf0.001"


def digests(spark, root):
    return sorted(map(tuple, table_digests(read_graph(spark, f"{current_version(spark, root)}/graph")).collect()))


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("versions"))
    canon = Fixtures(spark, SF).canonical()
    g = build_graph(canon=canon, validate="report", layer_root=root, versioned=True)
    return root, canon, g


def test_a_version_is_committed_whole(spark, first):
    root, _, g = first
    (number, version), = commits(spark, root)
    assert number == 1 and g.layer_root == f"{root}/versions/{version}" == current_version(spark, root)
    assert digests(spark, root) == sorted(map(tuple, table_digests(g.final_tables()).collect()))
    assert sorted(map(tuple, table_digests(read_graph(spark, f"{root}/graph")).collect())) == digests(spark, root)
    assert current_version(spark, f"{root}/nowhere") == f"{root}/nowhere"     # no versions kept there


@pytest.mark.parametrize("layer", ["subgraph", "graph"])
def test_a_failing_run_leaves_the_last_version(spark, first, layer, monkeypatch):
    root, canon, _ = first
    before, done = digests(spark, root), commits(spark, root)
    if layer == "subgraph":     # a table of the first layer cannot be made
        bad = F.when(F.col("keyword").isNotNull(), F.raise_error(F.lit("broken keyword"))).otherwise(F.col("keyword"))
        with pytest.raises(PySparkException, match="broken keyword"):
            build_graph(canon={**canon, "latest_keyword": canon["latest_keyword"].withColumn("keyword", bad)},
                        validate="report", layer_root=root, versioned=True)
    else:                       # the final tables are written, but one does not read back as written
        real = G.write_manifest

        def damaged(spark, tables, path, metrics):
            real(spark, tables, path, metrics)
            spark.read.parquet(f"{path}/node_url_final").limit(3).write.mode("append").parquet(f"{path}/node_url_final")

        monkeypatch.setattr(G, "write_manifest", damaged)
        with pytest.raises(RuntimeError, match="node_url"):
            build_graph(canon=canon, validate="report", layer_root=root, versioned=True)
    assert commits(spark, root) == done and digests(spark, root) == before
    left = {os.path.basename(v) for v in glob.glob(f"{root}/versions/*")}
    assert len(left) > 1                             # the failed run's files are there ...
    gone = drop_versions(spark, root)
    assert gone and digests(spark, root) == before   # ... until they are removed


def test_readers_keep_their_version(spark, first):
    root, canon, _ = first
    held = read_graph(spark, f"{current_version(spark, root)}/graph")
    before = sorted(map(tuple, table_digests(held).collect()))
    fewer = {**canon, "latest_url": canon["latest_url"].limit(5)}
    build_graph(canon=fewer, validate="report", layer_root=root, versioned=True)
    assert [n for n, _ in commits(spark, root)] == [1, 2]
    assert digests(spark, root) != before
    assert sorted(map(tuple, table_digests(held).collect())) == before
    assert drop_versions(spark, root, keep=2) == []
    assert len(drop_versions(spark, root, keep=1)) == 1


def test_catalog_from_metrics_equals_the_scanned_one(spark, first):
    root = first[0]
    layer = f"{current_version(spark, root)}/graph"
    tables = read_graph(spark, layer)
    nodes = {t[5:]: df for t, df in tables.items() if t.startswith("node_")}
    links = {t[5:]: df for t, df in tables.items() if t.startswith("link_")}
    ends = package_registry_spec().triplets()
    written = written_catalog(nodes, links, ends, read_metrics(spark, layer))
    assert "FileScan" not in written._jdf.queryExecution().executedPlan().toString()
    assert written.dtypes == graph_catalog(nodes, links, ends).dtypes
    assert sorted(map(tuple, written.collect()), key=repr) == sorted(map(tuple, graph_catalog(nodes, links, ends).collect()), key=repr)
    assert differing(spark, layer) == []


def test_commit_order(spark, tmp_path):
    root = str(tmp_path)
    names = [new_version(root)[0] for _ in range(12)]
    for n in names:
        commit_version(spark, root, n)
    assert [v for _, v in commits(spark, root)] == names
    assert current_version(spark, root + "/") == f"{root}/versions/{names[-1]}"
    open(f"{root}/_commits/note.txt", "w").close()
    assert [v for _, v in commits(spark, root)] == names
