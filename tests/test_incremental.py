"""Incremental versions: equal to a full build after inserts, changes and removals."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.errors import PySparkException

from propgraph import build_graph, update_graph
from propgraph.operators import table_digests
from propgraph.plans import incremental as I
from propgraph.sources import commits, current_version, read_graph

SCHEMA = "ord long, name string, latest string"
RND = random.Random(5)
LICENSES = ["MIT", "MIT", "MIT", "BSD", "Apache", "UNKNOWN", None]
WORDS = ["hot", "hot", "web", "data", "graph", "spark"]
PEOPLE = [("Ann", "ann@a.org"), ("Bob", "bob@b.org, bob@c.org"), (None, "x@d.org"), ("", "x@d.org"), ("Cy", None)]


def record(i, **given):
    author, email = PEOPLE[i % 5]
    info = {"name": f"p{i}", "package_url": f"https://r.org/p{i}", "requires_python": None, "version": "1",
            "license": LICENSES[RND.randrange(7)], "home_page": f"https://github.com/o{i % 4}/r{i % 9}", "docs_url": None,
            "keywords": ", ".join(RND.choices(WORDS, k=3)), "project_urls": {"Source": f"https://s{i % 3}.org/"},
            "author": author, "author_email": email, "maintainer": "Ann" if i % 3 else None, "maintainer_email": "ann@a.org"}
    requires = {f"p{(i * 7) % 40}": None, "base": {"releases": ["1.0", "2.0"], "requirement": ">1"}}
    return json.dumps({"num_releases": i % 4, "num_info_dependencies": 1, "info": {**info, **given}, "requires": requires})


START = [(i, f"p{i}", record(i)) for i in range(60)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def tables(spark, root):
    """The digest of every table of every layer of the current version."""
    last = current_version(spark, root)
    names = [f"{layer}/{t}" for layer in ("canon", "subgraph/node", "subgraph/link")
             for t in sorted(os.listdir(f"{last}/{layer}"))]
    found = {n: spark.read.parquet(f"{last}/{n}") for n in names}
    found.update(read_graph(spark, f"{root}/graph"))
    return sorted(map(tuple, table_digests(found).collect()))


def full(spark, rows, root, **kw):
    g = build_graph(frame(spark, rows), validate="report", layer_root=str(root), versioned=True, keyword_threshold=4,
                    keep_records=True, **kw)
    return str(root), sorted(map(tuple, g.check.collect()))


def removed(rows):
    """Without records that hold first occurrences of licenses and the first keywords."""
    return rows[3:20] + rows[22:]


def changed(rows):
    """Other texts, other names, and new records before and after all others."""
    out = [(o, "other" if o == 5 else n, record(o, license="BSD", keywords="spark", author_email="q@q.org")
            if o in (20, 30) else t) for o, n, t in rows]
    return out + [(-1, "early", record(100, license="MIT", keywords="hot, web, new")),
                  (99, "late", record(101, license="Rare", author="Zoe", author_email="z@z.org"))]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    return full(spark, START, tmp_path_factory.mktemp("kept"))[0]


def test_update_equals_a_full_build(spark, base, tmp_path, monkeypatch):
    """One root takes all changes in turn, so every update starts from an updated version."""
    decoded = []
    real = I.parse_raw
    monkeypatch.setattr(I, "parse_raw", lambda raw, how: decoded.append(raw.count()) or real(raw, how))
    rows = START
    for step, change in enumerate((removed, changed)):
        before = {o: (n, t) for o, n, t in rows}
        rows, name = change(rows), change.__name__
        g = update_graph(frame(spark, rows), base, validate="report", keyword_threshold=4)
        other, check = full(spark, rows, tmp_path / name)
        assert tables(spark, base) == tables(spark, other), name
        assert sorted(map(tuple, g.check.collect())) == check, name
        assert decoded[-1] == sum(before.get(o) != (n, t) for o, n, t in rows), name
        assert len(commits(spark, base)) == step + 2
        assert not os.path.exists(f"{g.layer_root}/delta")


def test_quarantine_stamps_and_failures(spark, tmp_path):
    rows = [(*r, "1") for r in START[:20]] + [(50, "bad", "{", "1"), (51, "bad2", "[]", "1")]
    raw = lambda rows: spark.createDataFrame(rows, SCHEMA + ", serial string")
    root = str(tmp_path / "kept")
    kw = {"validate": "report", "keyword_threshold": 4, "on_malformed": "drop", "stamp": "serial"}
    build_graph(raw(rows), layer_root=root, versioned=True, keep_records=True, **kw)
    # 50 is mended, 2 is broken, 3 has another text under its old stamp and does not count as changed
    rows = [(o, n, "x" if o == 2 else record(50) if o == 50 else "y" if o == 3 else t, "2" if o in (2, 50) else "1")
            for o, n, t, _ in rows]
    g = update_graph(raw(rows), root, **kw)
    assert sorted((r.ord, r.reason) for r in g.quarantine.collect()) == [(2, "latest:not json"), (51, "latest:not object")]
    same = [(o, n, START[3][2] if o == 3 else t, s) for o, n, t, s in rows]
    other = str(tmp_path / "full")
    build_graph(raw(same), layer_root=other, versioned=True, keep_records=True, **kw)
    assert tables(spark, root) == tables(spark, other)
    done = commits(spark, root)
    with pytest.raises(ValueError, match="kept version"):
        update_graph(raw(rows), root, **{**kw, "keyword_threshold": 5})
    with pytest.raises(ValueError, match="unique"):
        update_graph(raw(rows + rows[:1]), root, **kw)
    assert commits(spark, root) == done
    with pytest.raises(ValueError, match="records are kept"):
        build_graph(raw(rows), layer_root=root, keep_records=True)


def test_a_malformed_change_leaves_the_last_version(spark, base):
    before, done = tables(spark, base), commits(spark, base)
    with pytest.raises(PySparkException, match="malformed record: new"):
        update_graph(frame(spark, START + [(999, "new", "{")]), base, validate="report", keyword_threshold=4)
    assert commits(spark, base) == done and tables(spark, base) == before
