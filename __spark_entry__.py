"""

``entry(spark)``: the flagship, the whole pipeline from the raw JSON snapshot
to the final graph at sf0.001, as (table, n_rows).
``oracle_sql()``: the DuckDB statement for every key.

Inputs are the registry-shaped views of ``propgraph.sources.fixtures``, built
from the driver's tables, so every query's work grows with them.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from functools import reduce

# Importable when loaded by file path from any working directory; executors
# need nothing from here (every plan is built-in Spark expressions).
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import build_graph, package_registry_spec, update_graph
from propgraph.plans.spec import has_email_select, with_group_select
from propgraph.functions import key_id, not_both_blank, url_features
from propgraph.operators import (distinct_on, edge_type_summary, extract_link, extract_node,
                                 graph_catalog, person_resolution, population, resolved_tables,
                                 table_digests, with_resolved_persons)
from propgraph.operators.checks import SIDES
from propgraph.operators.resolve import PERSON_LINKS, PERSON_NODES
from propgraph.oracle import oracle_queries
from propgraph.plans import canon as C
from propgraph.plans.graph import GraphView
from propgraph.session import reliable_checkpoint, scratch_path
from propgraph.sources import Fixtures, parse_raw, publish, quarantine, read_graph, scan_raw
from propgraph.sources.layers import write_layer

SMOKE_DIR = "/root/testdata/sf0.001"


def _present(module: str) -> bool:
    """Whether an optional part of the repository is there; its own import
    errors are not swallowed."""
    spec = importlib.util.find_spec(module)
    return spec is not None and spec.origin is not None  # a leftover empty folder has no origin


HAS_LLM = _present("propgraph.llm") and _present("corpus_pipeline")
if HAS_LLM:
    import corpus_pipeline
    from propgraph.llm import queries as llm_queries


def entry(spark: SparkSession) -> DataFrame:
    """Raw snapshot -> canonical -> subgraph (checked) -> final graph.

    Reported, not raised: at sf0.001 no keyword reaches 300 occurrences, so
    the keyword table is empty, which stops a raising run by design.
    """
    return _raw_graph(spark, SMOKE_DIR, validate="report").counts()


# ----------------------------------------------------------------- helpers
def _fx(spark: SparkSession, sf: str) -> Fixtures:
    return Fixtures(spark, sf)


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_raw(_fx(spark, sf).raw())


def _raw_graph(spark: SparkSession, sf: str, **kw):
    return build_graph(raw=_fx(spark, sf).raw(), validate=kw.pop("validate", "report"), **kw)


def _view(spark: SparkSession, sf: str, spec=None) -> GraphView:
    # Lazy: only the tables a key needs are planned. Fixture emails name
    # packages beyond the package table at sf0.001, so the check keys report
    # orphans instead of raising.
    return GraphView(_fx(spark, sf).canonical(), spec)


def _attrs_text(df: DataFrame, cols: list[str]) -> F.Column:
    if not cols:
        return F.lit("")
    return F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------- sources / sinks
def q_scan_raw(spark, sf):
    path = scratch_path(spark, "raw", "latest")
    _fx(spark, sf).raw_snapshot().write.mode("overwrite").parquet(path)
    return scan_raw(spark, path)


def q_write_layers(spark, sf):
    """Every table of every layer, read back from its files."""
    root = scratch_path(spark, "layers")
    spec = _raw_graph(spark, sf, layer_root=root).spec
    folders = {"canon": {t: t for t in spec.inputs},
               "subgraph": {**{n: f"node/{n}" for n in spec.nodes}, **{n: f"link/{n}" for n in spec.links}},
               "graph": {f"{t}_final": f"{t}_final" for t in
                         [*(f"node_{n}" for n in spec.all_node_groups()), *(f"link_{n}" for n in spec.all_link_groups())]}}
    return _union([
        table_digests({n: spark.read.parquet(f"{root}/{layer}/{path}") for n, path in tables.items()})
        .withColumn("layer", F.lit(layer)) for layer, tables in folders.items()])


def q_publish(spark, sf):
    """The final tables, read back from the catalog."""
    published = publish(_view(spark, sf).final_tables(), database="propgraph_graph",
                        location=scratch_path(spark, "warehouse"))
    return table_digests(published)


# ----------------------------------------------------------------- canonicalize
def q_canon_parse(spark, sf):
    return C.parsed_fields(_parsed(spark, sf))


def q_canon_quarantine(spark, sf):
    """The records of a damaged snapshot that violate the record contract, and why."""
    return quarantine(_fx(spark, sf).raw_damaged())


def q_canon_license(spark, sf):
    # both sides of the first-occurrence join read the decoded rows
    pkg = reliable_checkpoint(C.canon_package(_parsed(spark, sf), keep_ord=True))
    return C.canon_license(pkg).select(*C.PACKAGE_COLUMNS)


def q_url_features(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return pages.withColumn("_f", url_features("url")).select(
        "page_id", "url", "_f.domain", "_f.top_level_domain", "_f.path")


def q_url_github(spark, sf):
    return C.canon_url(_parsed(spark, sf)).select(
        "pkg_name", "url", "url_type", "github_repo", "github_account")


def q_keyword_running(spark, sf):
    # the rule reads the tokens twice: decoded once, on disk
    path = scratch_path(spark, "keyword_tokens")
    C.canon_keyword(_parsed(spark, sf)).write.parquet(path)
    return C.keyword_running(spark.read.parquet(path))


def q_expect_nonempty(spark, sf):
    return C.canonical_counts(_parsed(spark, sf))


# ----------------------------------------------------------------- extraction
def _node_query(name: str):
    def q(spark, sf):
        spec = package_registry_spec().nodes[name]
        return extract_node(_fx(spark, sf).table(spec.source), spec)
    return q


def _link_query(name: str):
    def q(spark, sf):
        spec = package_registry_spec().links[name]
        return extract_link(_fx(spark, sf).table(spec.source), spec)
    return q


# ----------------------------------------------------------------- grouping
def q_node_population(spark, sf):
    v = _view(spark, sf)
    return _union([population([v.sub_node(c) for c in s.children], ["node_id"])
                   .select(F.lit(name).alias("group"), "node_id")
                   for name, s in v.spec.all_node_groups().items()])


def q_link_population(spark, sf):
    v = _view(spark, sf)
    return _union([population([v.sub_link(c) for c in s.children], ["from_id", "to_id"])
                   .select(F.lit(name).alias("group"), "from_id", "to_id")
                   for name, s in v.spec.all_link_groups().items()])


def q_group_nodes(spark, sf):
    v = _view(spark, sf)
    return _union([df.select(F.lit(f"node_{n}").alias("table"), "node_id")
                   for n, df in v.nodes().items()])


def q_group_links(spark, sf):
    v = _view(spark, sf)
    return _union([df.select(F.lit(f"link_{n}").alias("table"), "link_id", "from_id", "to_id")
                   for n, df in v.links().items()])


def _final(kind: str, name: str):
    def q(spark, sf):
        v = _view(spark, sf)
        return v.node(name) if kind == "node" else v.link(name)
    return q


def q_passthrough_nodes(spark, sf):
    v = _view(spark, sf)
    return _union([v.node(n).select(F.lit(f"node_{n}").alias("table"), "node_id",
                                    _attrs_text(v.node(n), v.node(n).columns[1:]).alias("attrs"))
                   for n in v.spec.all_node_groups() if n not in v.spec.node_groups])


def q_passthrough_links(spark, sf):
    v = _view(spark, sf)
    return _union([v.link(n).select(F.lit(f"link_{n}").alias("table"), "link_id", "from_id",
                                    "to_id", _attrs_text(v.link(n), v.link(n).columns[3:]).alias("attrs"))
                   for n in v.spec.all_link_groups() if n not in v.spec.link_groups])


def _swapped(spark, sf, kind, child, resolve):
    """Digests of all final tables after a resolved table took a child's place."""
    table = f"{child}_resolved"
    base = _view(spark, sf)
    resolved = resolve(base.sub_node(child) if kind == "node" else base.sub_link(child))
    spec = package_registry_spec().with_swap(kind, child, table)
    return table_digests(GraphView(base.canon, spec, {table: resolved}).final_tables())


def q_group_override(spark, sf):
    return _swapped(spark, sf, "node", "author", lambda t: t.withColumn("name", F.upper("name")))


def q_group_override_link(spark, sf):
    return _swapped(spark, sf, "link", "author_has_email",
                    lambda t: t.withColumn("link_id", F.reverse("link_id")))


def q_resolve_person(spark, sf):
    """Which persons are the same one: (node_id, resolved_id)."""
    return person_resolution(_view(spark, sf))


def q_group_resolved(spark, sf):
    """Digests of all final tables with the resolved persons swapped in."""
    base = _view(spark, sf)
    # read more than once each: the person tables by the resolution and by the tables made from
    # it, the requirements (an aggregate) by a node and a link table
    nodes, links = PERSON_NODES, [n for n, _ in PERSON_LINKS]
    once = write_layer({**{n: base.sub_node(n) for n in nodes}, **{n: base.sub_link(n) for n in links},
                        "latest_requirement": base.canon["latest_requirement"]}, scratch_path(spark, "resolve"))
    canon = {**base.canon, "latest_requirement": once.pop("latest_requirement")}
    view = GraphView(canon, base.spec, once)
    tables = resolved_tables(view, reliable_checkpoint(person_resolution(view)))
    return table_digests(GraphView(canon, with_resolved_persons(base.spec), tables).final_tables())


def q_group_has_email_coalesce(spark, sf):
    """has_email with the first non-NULL child link_id (the parity form keeps
    the author child's only)."""
    spec = with_group_select(package_registry_spec(), "link", "has_email",
                             has_email_select(parity=False))
    return _view(spark, sf, spec).link("has_email")


def q_build_graph(spark, sf):
    """The final tables of the whole pipeline, read back from the graph layer."""
    root = scratch_path(spark, "build")
    _raw_graph(spark, sf, layer_root=root)
    return table_digests(read_graph(spark, f"{root}/graph"))


def q_update_graph(spark, sf):
    """The final tables after an update from an earlier snapshot, in which a tenth of the
    records was not there yet, a tenth had another license and keywords, and a tenth came
    twice under other names: the whole snapshot's graph."""
    root, raw = scratch_path(spark, "update"), _fx(spark, sf).raw()
    tenth = lambda i: F.pmod(F.col("ord"), F.lit(10)) == i
    text = F.regexp_replace(F.regexp_replace("latest", '"license":"', '"license":"Old '), '"keywords":"', '"keywords":"old,')
    earlier = (raw.where(~tenth(0)).withColumn("latest", F.when(tenth(1), text).otherwise(F.col("latest")))
               .unionByName(raw.where(tenth(2)).withColumns({"ord": -F.col("ord") - 1, "name": F.concat("name", F.lit("-old"))})))
    build_graph(raw=earlier, validate="report", layer_root=root, versioned=True, keep_records=True)
    update_graph(raw, root, validate="report")
    return table_digests(read_graph(spark, f"{root}/graph"))


# ----------------------------------------------------------------- shared pieces
def q_distinct_on(spark, sf):
    return distinct_on(_fx(spark, sf).table("latest_url"), ["pkg_name", "url"])


def q_key_id(spark, sf):
    return _fx(spark, sf).table("latest_email").select(
        "pkg_name", "person_name", "email_record", "email",
        key_id("person_name", "email_record").alias("person_id"),
        key_id("email").alias("email_id"),
        key_id("pkg_name", "person_name", "email_record").alias("link_id"))


def q_not_both_blank(spark, sf):
    return (_fx(spark, sf).table("latest_email")
            .groupBy("role", not_both_blank("person_name", "email_record").alias("ok"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


# ----------------------------------------------------------------- checks / metadata
def _check(side: str | None):
    def q(spark, sf):
        return _view(spark, sf).check([side] if side else SIDES)
    return q


def q_edge_type_summary(spark, sf):
    v = _view(spark, sf)
    return edge_type_summary(v.links(), v.spec.triplets())


def q_graph_catalog(spark, sf):
    v = _view(spark, sf)
    return graph_catalog(v.nodes(), v.links(), v.spec.triplets())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    spec = package_registry_spec()
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "scan_raw": q_scan_raw,
        "write_layers": q_write_layers,
        "publish": q_publish,
        "canon_parse": q_canon_parse,
        "canon_quarantine": q_canon_quarantine,
        "canon_package": lambda s, sf: C.canon_package(_parsed(s, sf)),
        "canon_license": q_canon_license,
        "canon_requirement": lambda s, sf: C.canon_requirement(_parsed(s, sf)),
        "canon_url": lambda s, sf: C.canon_url(_parsed(s, sf)),
        "url_features": q_url_features,
        "url_github": q_url_github,
        "canon_person": lambda s, sf: C.person_rows(_parsed(s, sf)),
        "canon_email": lambda s, sf: C.canon_email(_parsed(s, sf)),
        "canon_keyword": lambda s, sf: C.canon_keyword(_parsed(s, sf)),
        "keyword_running": q_keyword_running,
        "expect_nonempty": q_expect_nonempty,
    }
    q.update({f"node_{n}": _node_query(n) for n in spec.nodes})
    q.update({f"link_{n}": _link_query(n) for n in spec.links})
    q.update({
        "node_population": q_node_population,
        "link_population": q_link_population,
        "group_nodes": q_group_nodes,
        "group_links": q_group_links,
        "group_package": _final("node", "package"),
        "group_person": _final("node", "person"),
        "group_domain": _final("node", "domain"),
        "group_has_email": _final("link", "has_email"),
        "group_has_email_coalesce": q_group_has_email_coalesce,
        "passthrough_nodes": q_passthrough_nodes,
        "passthrough_links": q_passthrough_links,
        "group_override": q_group_override,
        "group_override_link": q_group_override_link,
        "resolve_person": q_resolve_person,
        "group_resolved": q_group_resolved,
        "build_graph": q_build_graph,
        "update_graph": q_update_graph,
        "distinct_on": q_distinct_on,
        "key_id": q_key_id,
        "not_both_blank": q_not_both_blank,
        "check_from_id": _check("from_id"),
        "check_to_id": _check("to_id"),
        "check_graph": _check(None),
        "edge_type_summary": q_edge_type_summary,
        "graph_catalog": q_graph_catalog,
    })
    if HAS_LLM:
        q.update(llm_queries.queries())
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    sql = oracle_queries()
    if HAS_LLM:
        sql.update(llm_queries.oracle_sql())
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
