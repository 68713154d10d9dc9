"""The command line: build, publish and catalog on a written raw snapshot."""

from __future__ import annotations

from propgraph.__main__ import main
from propgraph.session import scratch_path
from propgraph.sources import Fixtures, read_graph

SF = "/root/testdata/sf0.01"


def test_build_publish_catalog(spark):
    root = scratch_path(spark, "cli")
    Fixtures(spark, SF).raw_snapshot().write.parquet(f"{root}/latest")
    main(["build", "--raw", f"{root}/latest", "--layers", f"{root}/layers"])
    final = read_graph(spark, f"{root}/layers/graph")
    assert len(final) == 21 and final["node_package"].count() == 13833
    main(["publish", "--layers", f"{root}/layers", "--database", "cli_test",
          "--location", f"{root}/warehouse"])
    assert spark.table("cli_test.link_has_email").count() == final["link_has_email"].count()
    main(["catalog", "--layers", f"{root}/layers", "--out", f"{root}/catalog"])
    cat = spark.read.parquet(f"{root}/catalog")
    assert cat.select("table").distinct().count() == 21
