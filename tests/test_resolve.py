"""Entity resolution and connected components against a union-find in plain Python."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from propgraph import build_graph, package_registry_spec
from propgraph.operators import (check_graph, connected_components, person_resolution, resolve_persons, resolved_links,
                                 resolved_nodes, resolved_tables, star_edges, with_resolved_persons)
from propgraph.operators import components, skew
from propgraph.plans.graph import GraphView
from propgraph.sources import Fixtures

SF = "/root/testdata/sf0.001"


class Union:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a

    def groups(self):
        return {x: self.find(x) for x in self.up}


def edges_of(kind):
    r = random.Random(3)
    names = [f"n{i:04d}" for i in range(90)]
    if kind == "sorted chain":
        return list(zip(names, names[1:]))
    if kind == "shuffled chain":
        r.shuffle(names)
        return list(zip(names, names[1:]))
    if kind == "star":
        return [(names[7], n) for n in names[8:]] + [(n, names[0]) for n in names[1:3]]
    if kind == "loops and twins":
        return [("a", "a"), ("b", "c"), ("c", "b"), ("b", "c"), ("d", "d")]
    return [(r.choice(names), r.choice(names)) for _ in range(60)]


@pytest.mark.parametrize("kind", ["sorted chain", "shuffled chain", "star", "loops and twins", "random", "none"])
def test_components(spark, kind, monkeypatch):
    edges = [] if kind == "none" else edges_of(kind)
    union = Union()
    for a, b in edges:
        union.join(a, b)
    if kind in ("star", "random"):
        monkeypatch.setattr(skew, "HOT_FLOOR", 20)
    df = spark.createDataFrame(edges, "u string, v string").repartition(3)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == union.groups()


def test_rounds_do_not_grow_with_a_chain(spark, monkeypatch):
    calls = []
    real = components._followed
    monkeypatch.setattr(components, "_followed", lambda *a: calls.append(1) or real(*a))
    connected_components(spark.createDataFrame(edges_of("sorted chain"), "u string, v string")).count()
    assert len(calls) <= 6   # 89 moves followed, four at a time at first


def test_star_edges_split_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_FLOOR", 10)
    rows = [(f"p{i}", "hot") for i in range(300)] + [(f"p{i}", f"k{i % 40}") for i in range(300)] + [("p3", "hot")]
    got = {tuple(r) for r in star_edges(spark.createDataFrame(rows, "node_id string, key string")).collect()}
    first: dict = {}
    for node, key in rows:
        first[key] = min(first.get(key, node), node)
    assert got == {(n, first[k]) for n, k in rows if first[k] != n}


def slow_resolution(persons, packages):
    names = {i: re.sub(r"[^\w]+|_+", " ", (name or "").lower()).strip() for i, name, _ in persons}
    uses: dict = {}
    for i, _, mail in persons:
        for a in (mail or "").lower().split(","):
            if "@" in a:
                uses.setdefault(a.strip(" "), set()).add(i)
    union = Union()
    for i in names:
        union.find(i)
    for who in uses.values():
        several = len({names[i] for i in who} - {""}) > 1
        for a in who:
            for b in who:
                if not several or names[a] == names[b]:
                    union.join(a, b)
    for p, a in packages:
        for q, b in packages:
            if p == q and a in names and b in names and names[a] and names[a] == names[b]:
                union.join(a, b)
    return union.groups()


def test_persons_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_FLOOR", 15)
    r = random.Random(4)
    mails = ["a@x.org", "A@X.org ", "b@x.org", "team@x.org", "c@y.org, a@x.org", "nomail", "", None, "d@z.org,e@z.org"]
    persons = [(f"id{i:03d}", r.choice(["Ann B", "ann  b.", "Bob", "Zoë K", "zoë_k", "", None, "Li"]),
                r.choice(mails + ["team@x.org"] * 5 + [f"u{k}@v.org" for k in range(60)])) for i in range(90)]
    packages = [(f"pkg{r.randint(0, 60)}", f"id{r.randint(0, 170):03d}") for _ in range(120)]
    got = {x.node_id: x.resolved_id for x in resolve_persons(
        spark.createDataFrame(persons, "node_id string, name string, email string"),
        spark.createDataFrame(packages, "package_id string, node_id string")).collect()}
    assert got == slow_resolution(persons, packages)


def test_resolved_rows_and_links(spark):
    nodes = spark.createDataFrame([("a", None, "x"), ("b", "Ann", ""), ("c", "Ann B", "y"), ("z", "", None)],
                                  "node_id string, name string, email string")
    same = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("z", "z")], "node_id string, resolved_id string")
    assert sorted(map(tuple, resolved_nodes(nodes, same).collect())) == [("a", "Ann", "x"), ("z", None, None)]
    links = spark.createDataFrame([("l1", "p", "a"), ("l2", "p", "c"), ("l3", "q", "z"), ("l4", "q", "gone")],
                                  "link_id string, from_id string, to_id string")
    assert sorted(map(tuple, resolved_links(links, "to_id", same).collect())) == [
        ("l1", "p", "a"), ("l3", "q", "z"), ("l4", "q", "gone")]


def test_resolved_graph_has_no_new_orphans(spark, tmp_path):
    base = GraphView(Fixtures(spark, SF).canonical(), package_registry_spec())
    resolved = person_resolution(base).cache()
    spec = with_resolved_persons(base.spec)
    view = GraphView(base.canon, spec, resolved_tables(base, resolved))
    assert resolved.select("resolved_id").distinct().count() < resolved.count()

    def orphans(v):
        return {(r.link, r.side): r.n_orphans for r in check_graph(v.nodes(), v.links(), spec.triplets()).collect()}

    before, after = orphans(base), orphans(view)
    assert all(after[k] <= before[k] for k in before)
    assert all(after[k] == 0 for k in (("has_author", "to_id"), ("has_maintainer", "to_id"), ("has_email", "from_id")))
    person = view.node("person")
    assert person.count() == person.select("node_id").distinct().count()
    assert {r.node_id for r in person.collect()} == {r.resolved_id for r in resolved.collect()}
    links = view.link("has_author")
    assert links.count() == links.select("from_id", "to_id").distinct().count()


def test_build_writes_the_resolution(spark, tmp_path):
    canon = Fixtures(spark, SF).canonical()
    g = build_graph(canon=canon, validate="report", layer_root=str(tmp_path), resolve=True)
    said = spark.read.parquet(f"{tmp_path}/resolved/person")
    assert said.count() == g.resolved.count() > g.nodes["person"].count()
    assert g.nodes["person"].select(F.col("node_id")).exceptAll(said.select("resolved_id").distinct()).count() == 0


def test_persons_are_read_once(spark):
    """The person tables feed the evidence and the result; they are extracted once."""
    from pyspark.sql import functions as F
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    rows = [("a", "Ann", "a@x"), ("b", "Ann", "b@x"), ("c", "Bo", "a@x")]
    persons = spark.createDataFrame(rows, "node_id string, name string, email string").withColumn("node_id", seen("node_id"))
    packages = spark.createDataFrame([("p", "a"), ("p", "b")], "package_id string, node_id string")
    got = {r.node_id: r.resolved_id for r in resolve_persons(persons, packages).collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}
    assert read.value == len(rows)
