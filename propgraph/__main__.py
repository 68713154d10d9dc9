"""Command line: the pipeline's two entry points plus the catalog profile.

  spark-submit propgraph_cli.py build   --raw PATH --layers ROOT [--ord-col ord | --ord-by-name]
                                   [--on-malformed fail|drop|keep] [--resolve-persons] [--keep-records]
  spark-submit propgraph_cli.py update  --raw PATH --layers ROOT   (after build --keep-records)
  spark-submit propgraph_cli.py canon   --canon FOLDER --layers ROOT
  spark-submit propgraph_cli.py publish --layers ROOT --database NAME [--location PATH]
  spark-submit propgraph_cli.py catalog --layers ROOT [--out PATH]
  spark-submit propgraph_cli.py drop    --layers ROOT [--keep N]

A build writes a new version below ROOT and commits it when it reads back as
written (``--in-place`` overwrites instead); publish and catalog read the current one.

(or ``python -m propgraph ...`` for a local session). The session comes from
the launcher (master, ``spark.checkpoint.dir``, resources); nothing is
overridden here.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators import edge_type_summary, written_catalog, graph_catalog
from .plans.graph import build_graph
from .plans.incremental import update_graph
from .plans.spec import package_registry_spec
from .sources import current_version, drop_versions, publish, read_graph, read_metrics, scan_raw


def _split(final):
    nodes = {t.removeprefix("node_"): df for t, df in final.items() if t.startswith("node_")}
    links = {t.removeprefix("link_"): df for t, df in final.items() if t.startswith("link_")}
    return nodes, links


def _show(report: DataFrame) -> None:
    """Print a whole report: one row per check, table or column, whatever the spec."""
    rows = report.collect()
    print(" | ".join(report.columns))
    for r in rows:
        print(" | ".join(str(v) for v in r))


def main(argv: list[str] | None = None) -> None:
    """Parse the command line and run one command."""
    ap = argparse.ArgumentParser(prog="propgraph")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="raw snapshot -> canonical, subgraph and graph layers")
    u = sub.add_parser("update", help="the next version from the last one and a new raw snapshot")
    for cmd in (b, u):
        cmd.add_argument("--raw", required=True, help="parquet with name, latest (and ord)")
        cmd.add_argument("--layers", required=True, help="root folder for the three layers")
        cmd.add_argument("--ord-col", default="ord", help="input order column, unique and not NULL")
        cmd.add_argument("--ord-by-name", action="store_true", help="order by name instead")
        cmd.add_argument("--validate", choices=("raise", "report"), default="raise")
        cmd.add_argument("--on-malformed", choices=("fail", "drop", "keep"), default="fail")
    b.add_argument("--keep-records", action="store_true", help="leave the decoded records beside the layers, for update")
    b.add_argument("--resolve-persons", action="store_true", help="make persons that are the same one node")
    n = sub.add_parser("canon", help="canonical tables -> subgraph and graph layers")
    n.add_argument("--canon", required=True, help="folder with the five latest_* tables")
    n.add_argument("--layers", required=True, help="root folder for the layers")
    n.add_argument("--validate", choices=("raise", "report"), default="raise")
    for cmd in (b, n):
        cmd.add_argument("--in-place", action="store_true",
                         help="overwrite the layers instead of committing a new version below the root")
    d = sub.add_parser("drop", help="remove all but the last versions")
    d.add_argument("--layers", required=True)
    d.add_argument("--keep", type=int, default=2)
    p = sub.add_parser("publish", help="save the final tables of a graph layer in a catalog")
    p.add_argument("--layers", required=True)
    p.add_argument("--database", default="graph")
    p.add_argument("--location", default=None)
    c = sub.add_parser("catalog", help="profile of the final tables and edge types")
    c.add_argument("--layers", required=True)
    c.add_argument("--out", default=None, help="write the profile here (parquet) instead of showing it")
    args = ap.parse_args(argv)

    spark = (SparkSession.builder.appName(f"propgraph-{args.cmd}")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    spec = package_registry_spec()
    if args.cmd == "build":
        source = scan_raw(spark, args.raw, None if args.ord_by_name else args.ord_col)
        g = build_graph(raw=source, spec=spec, layer_root=args.layers, validate=args.validate,
                        on_malformed=args.on_malformed, resolve=args.resolve_persons,
                        versioned=not args.in_place, keep_records=args.keep_records)
        _show(g.check)
        if g.quarantine is not None:
            _show(g.quarantine.groupBy("reason").count().orderBy("reason"))
        _show(g.counts())
    elif args.cmd == "update":
        source = scan_raw(spark, args.raw, None if args.ord_by_name else args.ord_col)
        g = update_graph(source, args.layers, spec, validate=args.validate, on_malformed=args.on_malformed)
        _show(g.check)
        _show(g.counts())
    elif args.cmd == "canon":
        canon = {t: spark.read.parquet(f"{args.canon}/{t}") for t in spec.inputs}
        g = build_graph(canon=canon, spec=spec, layer_root=args.layers, validate=args.validate,
                        versioned=not args.in_place)
        _show(g.check)
        _show(g.counts())
    elif args.cmd == "drop":
        print(f"removed {len(drop_versions(spark, args.layers, args.keep))} versions")
    elif args.cmd == "publish":
        published = publish(read_graph(spark, f"{current_version(spark, args.layers)}/graph"), args.database, args.location)
        print(f"published {len(published)} tables to {args.database}")
    else:
        layer = f"{current_version(spark, args.layers)}/graph"
        nodes, links = _split(read_graph(spark, layer))
        metrics = read_metrics(spark, layer)     # taken while writing: no data file is read
        profile = (written_catalog(nodes, links, spec.triplets(), metrics) if metrics
                   else graph_catalog(nodes, links, spec.triplets()))
        if args.out:
            profile.write.mode("overwrite").parquet(args.out)
        else:
            _show(profile)
            _show(edge_type_summary(links, spec.triplets()))


if __name__ == "__main__":
    main()
