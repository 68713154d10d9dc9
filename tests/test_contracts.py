"""Contracts of the pipeline: malformed records, order columns, swaps, layers
that can be rebuilt and moved, digests, and plans that decode and read once."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as E
from propgraph import build_graph, package_registry_spec
from propgraph.operators import (check_graph, extract_node, null_first_occurrence, require_order,
                                 table_digests)
from propgraph.plans import canon as C
from propgraph.plans.graph import GraphView
from propgraph.plans.spec import NodeSpec
from propgraph.session import scratch_path
from propgraph.sources import Fixtures, parse_raw, quarantine, read_graph, scan_raw

SF = "/root/testdata/sf0.001"
KEYS = ("name", "package_url", "requires_python", "version", "license", "home_page", "docs_url", "keywords",
        "project_urls", "author", "author_email", "maintainer", "maintainer_email")
INFO = {**dict.fromkeys(KEYS), "name": "n", "home_page": "https://x.org"}
TOP = {"num_releases": 1, "num_info_dependencies": None, "info": INFO, "requires": None}
GOOD = {"releases": ["1.0"], "requirement": ">1"}


def record(info=None, without=(), **top) -> str:
    """A full record with other values, without some keys (``info.x`` or ``x``)."""
    r = {**TOP, "info": {**INFO, **(info or {})}, **top}
    for path in without:
        del (r["info"] if "." in path else r)[path.split(".")[-1]]
    return json.dumps(r)


URLS_TWICE = record({"project_urls": {"a": "u1"}}).replace('"a": "u1"', '"a": "u1", "a": "u2"')
NEEDS_TWICE = record(requires={"r": {"releases": [], "requirement": "old"}}).replace(
    '"requires": {', '"requires": {"r": {"releases": [], "requirement": "first"}, ').replace('"old"', '"new"')
# why: (record, its reason codes)
BAD = {
    "entry is text": (record(requires={"a": GOOD, "b": "oops"}), "requires.entry:not object"),
    "entry is a list": (record(requires={"a": GOOD, "b": ["1.0"]}), "requires.entry:not object"),
    "entry without releases": (record(requires={"a": GOOD, "b": {"requirement": ">1"}}), "requires.releases:absent"),
    "entry without requirement": (record(requires={"b": {"releases": []}}), "requires.requirement:absent"),
    "releases is text": (record(requires={"b": {"releases": "1.0", "requirement": ">1"}}), "requires.releases:not texts"),
    "releases of numbers": (record(requires={"b": {"releases": [1], "requirement": None}}), "requires.releases:not texts"),
    "requirement is a list": (record(requires={"b": {"releases": [], "requirement": []}}), "requires.requirement:not text"),
    "requires is a list": (record(requires=["a"]), "requires:not object"),
    "text count": (record(num_releases="abc"), "num_releases:not number"),
    "boolean count": (record(num_info_dependencies=True), "num_info_dependencies:not number"),
    "no text": (None, "latest:absent"), "not json": ("{", "latest:not json"), "empty": ("", "latest:not json"),
    "a list": ("[1]", "latest:not object"), "null": ("null", "latest:not object"),
    "no info": (record(without=["info"]), "info:absent"), "null info": (json.dumps({**TOP, "info": None}), "info:absent"),
    "info is text": (json.dumps({**TOP, "info": "x"}), "info:not object"),
    "no count": (record(without=["num_releases"]), "num_releases:absent"),
    "no requires": (record(without=["requires"]), "requires:absent"),
    "no license": (record(without=["info.license"]), "info.license:absent"),
    "no keywords, no author": (record(without=["info.keywords", "info.author"]), "info.keywords:absent, info.author:absent"),
    "license is an object": (record({"license": {"a": 1}}), "info.license:not text"),
    "license is a number": (record({"license": 3}), "info.license:not text"),
    "home page is a number": (record({"home_page": 5}), "info.home_page:not text"),
    "docs url is a list": (record({"docs_url": ["u"]}), "info.docs_url:not text"),
    "a project url is an object": (record({"project_urls": {"a": {"b": 1}}}), "info.project_urls:not text"),
    "author is a number": (record({"author": 5, "author_email": "a@x"}), "info.author:not text"),
    "two faults": (record({"version": 1}, requires={"b": 1}), "info.version:not text, requires.entry:not object"),
    "repeated url key": (URLS_TWICE, "latest:repeated key"), "repeated needs key": (NEEDS_TWICE, "requires:repeated key"),
}
FINE = [record(), record({"keywords": ["a"], "project_urls": ["u"]}), record({"project_urls": {}}), record(requires={}),
        record(num_releases=2.5, requires={"a": GOOD, "b": None}), record({"author_email": ["a@x"], "author": 5}),
        record({"project_urls": {"a": None, "b": "u"}}), record(more={"x": 1}), record({"maintainer_email": {"a": 1}}),
        record(requires={"a": {"releases": [], "requirement": None, "more": 1}})]


def _raw(spark, latest):
    rows = [(0, "ok", record(requires={"a": GOOD, "b": None}))] + [(i + 1, f"bad{i}", x) for i, x in enumerate(latest)]
    return spark.createDataFrame(rows, "ord long, name string, latest string")


STOPS = ["entry is text", "entry is a list", "entry without releases", "releases is text", "requires is a list", "text count",
         "no text", "not json", "no info", "info is text", "repeated url key", "repeated needs key", "no requires",
         "license is an object"]     # the others differ by their reason codes only


@pytest.mark.parametrize("why", STOPS)
def test_malformed_records_stop_the_job(spark, why):
    raw = _raw(spark, [BAD[why][0]])
    every = why in ("entry is text", "license is an object", "no requires", "repeated url key")
    for table in (C.canon_package, *((C.canon_requirement, C.canon_url, C.canonical_counts) if every else ())):
        with pytest.raises(PySparkException, match="malformed record: bad0"):
            table(parse_raw(raw)).collect()


def test_every_violation_has_its_reason(spark):
    raw = _raw(spark, [r for r, _ in BAD.values()])
    got = {r.name: (r.reason, r.latest) for r in quarantine(raw).collect()}
    assert got == {f"bad{i}": (reason, text) for i, (text, reason) in enumerate(BAD.values())}


def test_malformed_records_dropped_or_kept(spark):
    raw = _raw(spark, [r for r, _ in BAD.values()])
    dropped = parse_raw(raw, on_malformed="drop")
    assert [r.pkg_name for r in C.canon_package(dropped).collect()] == ["ok"]
    assert {r.required_pkg_name for r in C.canon_requirement(dropped).collect()} == {"a", "b"}
    kept = parse_raw(raw, on_malformed="keep")
    assert C.canon_package(kept).count() == 1 + len(BAD)
    at = f"bad{list(BAD).index('repeated needs key')}"
    assert [(r.required_pkg_name, r.requirement_string) for r in
            C.canon_requirement(kept).where(F.col("pkg_name") == at).collect()] == [("r", "new")]
    with pytest.raises(ValueError):
        parse_raw(raw, on_malformed="ignore")


def test_good_records_are_not_malformed(spark):
    parsed = parse_raw(_raw(spark, FINE))
    assert C.canon_package(parsed).count() == 1 + len(FINE)
    # values that are no text where any may stand: no rows, as no rows come from them by the rules
    assert C.canon_email(parsed).count() == 0 and C.canon_keyword(parsed).count() == 0
    assert {(r.url_type, r.url) for r in C.canon_url(parsed).where("url_type NOT IN ('home_page', 'docs_url')").collect()} \
        == {("b", "u")}
    assert quarantine(_raw(spark, FINE)).count() == 0


def test_dropped_records_are_quarantined_by_the_build(spark, tmp_path):
    raw = _raw(spark, [r for r, _ in BAD.values()] + FINE)
    root = str(tmp_path / "layers")
    g = build_graph(raw=raw, validate="report", on_malformed="drop", layer_root=root)
    written = spark.read.parquet(f"{root}/canon/_quarantine")
    assert sorted(written.collect(), key=lambda r: r.ord) == sorted(quarantine(raw).collect(), key=lambda r: r.ord)
    assert written.count() + g.canon["latest_package"].count() == raw.count()
    assert g.quarantine.count() == len(BAD) and g.canon["latest_package"].count() == 1 + len(FINE)
    lazy = build_graph(raw=raw, validate="report", on_malformed="drop", materialize=None)
    assert lazy.quarantine.count() == len(BAD)
    assert sorted(table_digests(lazy.final_tables()).collect()) == sorted(table_digests(g.final_tables()).collect())
    clean = build_graph(raw=_raw(spark, FINE), validate="report", on_malformed="drop", layer_root=str(tmp_path / "clean"))
    assert clean.quarantine.count() == 0
    assert build_graph(raw=_raw(spark, FINE), validate="report", materialize=None).quarantine is None


def test_order_column(spark):
    path = scratch_path(spark, "order")
    _raw(spark, [record()]).write.parquet(path)
    assert [r.ord for r in scan_raw(spark, path).orderBy("name").collect()] == [1, 0]
    assert [r.ord for r in scan_raw(spark, path, None).orderBy("name").collect()] == ["bad0", "ok"]
    with pytest.raises(ValueError, match="sequence"):
        scan_raw(spark, path, "sequence")
    for bad in ([(1, "a"), (1, "b")], [(None, "a"), (2, "b")], [(None, "a"), (None, "b")]):
        df = spark.createDataFrame(bad, "ord long, name string")
        with pytest.raises(ValueError, match="unique"):
            require_order(df, ["ord"])
        raw = df.withColumn("latest", F.lit(record()))
        with pytest.raises(ValueError, match="unique"):
            build_graph(raw=raw, validate="report")
    require_order(spark.createDataFrame([(1, 1), (1, 2)], "a int, b int"), ["a", "b"])
    assert null_first_occurrence(spark.createDataFrame([(1, "v")], "ord int, v string"), "v", "ord").first().v is None


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, x), root) for d, names, _ in os.walk(root) for x in names)


def test_layers_are_complete_rebuildable_and_movable(spark, tmp_path):
    raw = Fixtures(spark, SF).raw()
    root = str(tmp_path / "layers")
    before = table_digests(build_graph(raw=raw, validate="report", layer_root=root).final_tables()).collect()
    folders = _files(root)
    again = table_digests(build_graph(raw=raw, validate="report", layer_root=root).final_tables()).collect()
    assert sorted(before) == sorted(again) and _files(root) == folders
    assert {f for f in folders if f.startswith("canon/")} == {
        f"canon/latest_{t}" for t in ("package", "requirement", "url", "keyword", "email")}
    assert len([f for f in folders if f.startswith("graph/") and f.endswith("_final")]) == 21
    assert len([f for f in folders if f.startswith("subgraph/") and f.count("/") == 2]) == 25
    moved = str(tmp_path / "elsewhere")
    shutil.copytree(root, moved)
    assert sorted(table_digests(read_graph(spark, f"{moved}/graph")).collect()) == sorted(before)


def test_digests_see_one_changed_attribute(spark):
    df = spark.createDataFrame([(i, f"v{i}", None) for i in range(50)], "node_id int, a string, b string")
    base = table_digests({"t": df}).collect()
    assert base == table_digests({"t": df.repartition(7).select("b", "a", "node_id")}).collect()
    for other in (df.withColumn("a", F.when(F.col("node_id") == 7, "x").otherwise(F.col("a"))),
                  df.withColumn("b", F.when(F.col("node_id") == 7, "").otherwise(F.col("b"))),
                  df.where("node_id != 7"), df.unionByName(df.limit(1))):
        assert table_digests({"t": other}).collect() != base
    assert table_digests({"t": df.limit(0)}).first().n_rows == 0


def test_swap_keeps_groups_tables_and_ends(spark):
    base = package_registry_spec()
    view = GraphView(Fixtures(spark, SF).canonical(), base)
    for kind, child, new in (("node", "maintainer", "author"), ("node", "author", "any_name"),
                             ("link", "author_has_email", "new_links"), ("link", "has_url", "better")):
        spec = base.with_swap(kind, child, new)
        assert spec.triplets() == base.triplets() and len(spec.triplets()) == 12
        tables = {} if new == "author" else {new: view.sub_node(child) if kind == "node" else view.sub_link(child)}
        final = GraphView(view.canon, spec, tables).final_tables()
        assert list(final) == list(view.final_tables()) and len(final) == 21
    # the same table under another name changes nothing; other groups never change
    spec = base.with_swap("node", "author", "copy")
    same = GraphView(view.canon, spec, {"copy": view.sub_node("author")})
    for n in ("person", "domain"):
        assert sorted(map(repr, same.node(n).collect())) == sorted(map(repr, view.node(n).collect()))
    with pytest.raises(ValueError, match="no node table"):
        base.with_swap("node", "nobody", "x")
    with pytest.raises(ValueError, match="to group"):
        GraphView(view.canon, spec).node("person")
    with pytest.raises(ValueError, match="no table of the graph"):
        GraphView(view.canon, base, {"copy": view.sub_node("author")})


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_json_is_decoded_once(spark):
    for key in ("expect_nonempty", "canon_license", "keyword_running", "canon_url"):
        assert _plan(E.queries()[key](spark, SF)).count("from_json(") <= 1, key


def test_one_sided_checks_read_one_side(spark, tmp_path):
    spec = package_registry_spec()
    view = GraphView(Fixtures(spark, SF).canonical(), spec)
    links = {}
    for n in ("has_url", "url_hosted_by"):
        view.sub_link(n).write.parquet(str(tmp_path / n))
        links[n] = spark.read.parquet(str(tmp_path / n))
    ends = {n: spec.subgraphs[n] for n in links}
    for side, other in (("from_id", "to_id"), ("to_id", "from_id")):
        plan = check_graph(view.sub_nodes(), links, ends, [side])._jdf.queryExecution().executedPlan().toString()
        assert f"ReadSchema: struct<{side}:string>" in plan and other not in plan


def test_undetermined_attributes_need_a_picked_row(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("j", "c"), ("j", "c")], "key string, attr string")
    attrs = (("key", "key"), ("attr", "attr"))
    picked = extract_node(df, NodeSpec("x", "s", ("key",), attrs)).collect()
    assert sorted((r.key, r.attr) for r in picked) == [("j", "c"), ("k", "a")]
    fixed = df.where("attr != 'b'")
    plan = extract_node(fixed, NodeSpec("x", "s", ("key",), attrs, determined=True))
    assert sorted((r.key, r.attr) for r in plan.collect()) == [("j", "c"), ("k", "a")]
    assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_fixture_keys_grow_with_the_tables(spark):
    for key in ("node_email", "node_email_domain", "node_author", "node_url"):
        small, large = (E.queries()[key](spark, f"/root/testdata/{sf}").count() for sf in ("sf0.001", "sf0.01"))
        assert large > 3 * small, (key, small, large)


@pytest.mark.parametrize("of", [quarantine, lambda raw: parse_raw(raw, "drop")])
def test_json_is_decoded_once_below_a_filter(spark, of):
    raw = spark.createDataFrame([(1, "p", record())], "ord long, name string, latest string")
    assert _plan(of(raw)).count("from_json(") == 1


def test_contract_is_compiled_and_parses_no_read_text_again(spark):
    raw = spark.createDataFrame([(1, "p", record())], "ord long, name string, latest string")
    plan = _plan(parse_raw(raw, "keep"))
    assert "filter(array(" not in plan           # a lambda around the codes has them interpreted
    assert "get_json_object(latest" not in plan and "parseJson(latest" not in plan


@pytest.mark.parametrize("entry", [
    None, {"releases": [], "requirement": "r"}, {"releases": ["1"], "requirement": None},
    {"releases": [None], "requirement": "r", "more": 1}, {"releases: ARRAY<STRING>, requirement": "r"}, {"releases": "1", "requirement": "r"},
    {"releases": ["1", 2], "requirement": "r"}, {"releases": ["1"], "requirement": 3}, {}, "text", 5, ["1"]])
def test_entries_that_are_not_plain_are_looked_into(spark, entry):
    from propgraph.sources.raw import judge_raw
    latest = record(requires={"a": {"releases": ["1"], "requirement": "r"}, "b": entry})
    raw = spark.createDataFrame([(1, "p", latest)], "ord long, name string, latest string")
    want = []
    if entry is not None and not isinstance(entry, dict):
        want = ["requires.entry:not object"]
    elif isinstance(entry, dict):
        want = [f"requires.{c}:absent" for c in ("releases", "requirement") if c not in entry]
        releases = entry.get("releases", [])
        if not isinstance(releases, list) or not (all(isinstance(r, str) for r in releases) or all(r is None for r in releases)):
            want.append("requires.releases:not texts")
        if not isinstance(entry.get("requirement"), (str, type(None))):
            want.append("requires.requirement:not text")
    assert judge_raw(raw).first().reasons == want
