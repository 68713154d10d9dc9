"""Canonicalize end to end, per table and single pass: flat rows are generated
first and the JSON records are built from them, so the expected tables are
known by construction."""

from __future__ import annotations

import json
import os
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propgraph.plans import canon as C
from propgraph.session import scratch_path
from propgraph.sources.raw import parse_raw

FUZZ = settings(max_examples=int(os.environ.get("FUZZ_EXAMPLES", "5")), deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])

TEXT = st.one_of(st.none(), st.sampled_from(["", "x", "UNKNOWN", "MIT", "a b"]))
# a count as JSON, and as read
COUNT = st.sampled_from([(None, None), (0, 0), (7, 7), (3.0, 3), (2.5, 2), (3.5, 4), (1.4, 1)])
# a URL as JSON, and its row: url, domain, top-level domain, path, repository, account
URL = st.sampled_from([
    (None, (None,) * 6), ("", ("",) + (None,) * 5), ("<>", ("",) + (None,) * 5),
    ("<https://x.org/p?q>", ("https://x.org/p?q", "x.org", "org", "/p", None, None)),
    ("https://github.com/o/r.git", ("https://github.com/o/r.git", "github.com", "com", "/o/r.git", "o/r", "o")),
    ("https://github.com/me", ("https://github.com/me", "github.com", "com", "/me", None, "me"))])
# an email field as (person, text), and its rows: name, record, email, domain, top-level domain
MAIL = st.sampled_from([
    (("P", None), []), (("P", ""), [("P", "", "", "", None)]),
    ((None, "Jo <j@x.org>"), [("Jo", "j@x.org", "j@x.org", "x.org", "org")]),
    (("P", "Jo <j@x.org>, B <b@y>"), [("P", "j@x.org", "j@x.org", "x.org", "org")]),
    (("P <q>", " Jo  <j@x.org>"), [("Jo", "j@x.org", "j@x.org", "x.org", "org")]),
    ((None, "a@x.org, b@y"), [(None, "a@x.org, b@y", "a@x.org", "x.org", "org"),
                              (None, "a@x.org, b@y", " b@y", "y", None)])])
# keywords as JSON, and as read
WORDS = st.sampled_from([(None, []), ("", []), ("a B", ["a", "b"]), ('["k one", "K2"]', ["k one", "k2"]),
                         ("a,,b", ["a", "b"]), (["k1", "k2"], [])])
# one requires entry as JSON, and its row: number, text, newest, oldest ('' text: the key)
NEED = st.sampled_from([(None, (0, "", None, None)), ({"releases": [], "requirement": ">1"}, (0, ">1", None, None)),
                        ({"releases": ["1.9", "1.10", "2.0"], "requirement": "==2"}, (3, "==2", "2.0", "1.10")),
                        ({"releases": ["1"], "requirement": None}, (1, None, "1", "1"))])
RECORD = st.fixed_dictionaries({
    "counts": st.tuples(COUNT, COUNT), "texts": st.tuples(TEXT, TEXT, TEXT, TEXT, TEXT),
    "home_page": URL, "docs_url": URL, "words": WORDS, "author": MAIL, "maintainer": MAIL,
    "urls": st.one_of(st.none(), st.dictionaries(st.sampled_from(["Source", "Docs", "None"]), URL, max_size=3),
                      st.just(["a list"])),
    "needs": st.one_of(st.none(), st.dictionaries(st.sampled_from(["r1", "r2", "r3"]), NEED, max_size=3))})


def to_json(r) -> str:
    name, page, python, version, license_ = r["texts"]
    urls = {k: u[0] for k, u in r["urls"].items()} if isinstance(r["urls"], dict) else r["urls"]
    return json.dumps({
        "num_releases": r["counts"][0][0], "num_info_dependencies": r["counts"][1][0],
        "info": {"name": name, "package_url": page, "requires_python": python, "version": version,
                 "license": license_, "home_page": r["home_page"][0], "docs_url": r["docs_url"][0],
                 "keywords": r["words"][0], "author": r["author"][0][0], "author_email": r["author"][0][1],
                 "maintainer": r["maintainer"][0][0], "maintainer_email": r["maintainer"][0][1],
                 "project_urls": urls},
        "requires": r["needs"] and {k: v[0] for k, v in r["needs"].items()}})


def expected(records) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("package", "requirement", "url", "email", "keyword")}
    for i, r in enumerate(records):
        p = f"p{i}"
        out["package"].append((p, *r["texts"][:4], r["counts"][0][1], r["counts"][1][1], r["texts"][4]))
        out["requirement"] += [(p, k, n, k if t == "" else t, new, old)
                               for k, (_, (n, t, new, old)) in (r["needs"] or {}).items()]
        pairs = [*(r["urls"].items() if isinstance(r["urls"], dict) else []),
                 ("home_page", r["home_page"]), ("docs_url", r["docs_url"])]
        out["url"] += [(p, row[0], kind, *row[1:]) for kind, (text, row) in pairs
                       if text is not None or kind in ("home_page", "docs_url")]
        out["email"] += [(p, *row, role) for role in ("author", "maintainer") for row in r[role][1]]
        out["keyword"] += [(p, w) for w in r["words"][1]]
    return out


def _bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@FUZZ
@given(records=st.lists(RECORD, min_size=1, max_size=25))
def test_canonicalize(spark, records):
    rows = [(i, f"p{i}", to_json(r)) for i, r in enumerate(records)]
    parsed = parse_raw(spark.createDataFrame(rows, "ord long, name string, latest string"))
    want = expected(records)
    path = scratch_path(spark, "fuzz-entries")
    C.canonical_entries(parsed).write.parquet(path)
    one = spark.read.parquet(path)

    def kind(k):
        return one.select(F.explode(k).alias("e")).select("e.*")

    for got in (C.canon_package(parsed), C._finish_package(kind("package"))):
        assert _bag(got) == sorted(want["package"], key=repr)
    for got in (C.canon_requirement(parsed), C._finish_requirement(kind("requirement"))):
        assert _bag(got) == sorted(want["requirement"], key=repr)
    for got in (C.canon_url(parsed), C.with_url_features(C._finish_url_rows(kind("url")))):
        assert _bag(got) == sorted(want["url"], key=repr)
    for got in (C.canon_email(parsed), C._finish_email(kind("person"))):
        assert _bag(got) == sorted(want["email"], key=repr)
    for got in (C.canon_keyword(parsed), C._finish_keyword(kind("keyword"))):
        assert [(r.pkg_name, r.keyword) for r in got.orderBy("ord", "pos").collect()] == want["keyword"]
    counts = {r.table: r.n_rows for r in C.canonical_counts(parsed, 1).collect()}
    words = Counter(w for _, w in want["keyword"])
    assert counts == {"latest_package": len(rows), "latest_requirement": len(want["requirement"]),
                      "latest_url": len(want["url"]), "latest_email": len(want["email"]),
                      "latest_keyword": sum(n - 1 for n in words.values())}
