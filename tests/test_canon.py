"""Canonicalize on hand-written JSON records."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propgraph.plans import canon as C
from propgraph.sources.raw import parse_raw


TOP = {"num_releases": None, "num_info_dependencies": None, "requires": None}


def _raw(spark, records):
    """Records as JSON; those with ``info`` get the other keys of a full record."""
    rows = [(i, name, rec if isinstance(rec, str) or rec is None else json.dumps({**TOP, **rec} if "info" in rec else rec))
            for i, (name, rec) in enumerate(records)]
    return spark.createDataFrame(rows, "ord long, name string, latest string")


def _info(**kw):
    base = {k: None for k in ("name", "package_url", "requires_python", "version", "license",
                              "home_page", "docs_url", "keywords", "author", "author_email",
                              "maintainer", "maintainer_email", "project_urls")}
    base.update(kw)
    return base


def test_malformed_json_fails_or_drops(spark):
    raw = _raw(spark, [("ok", {"info": _info(name="ok")}), ("bad", "{not json"),
                       ("noinfo", {"num_releases": 1})])
    with pytest.raises(PySparkException):
        C.canon_package(parse_raw(raw)).collect()
    kept = C.canon_package(parse_raw(raw, on_malformed="drop")).collect()
    assert [r.pkg_name for r in kept] == ["ok"]


def test_numbers_urls_keywords_types(spark):
    raw = _raw(spark, [
        ("a", {"num_releases": 3.0, "num_info_dependencies": 2,
               "info": _info(project_urls=["https://x.org"], home_page="<https://h.org/p>",
                             keywords=["k1", "k2"])}),
        ("b", {"num_releases": 4, "info": _info(
            project_urls={"Source": "https://github.com/o/r", "Empty": None},
            keywords="K1, k2", docs_url=None)}),
    ])
    parsed = parse_raw(raw)
    pkg = {r.pkg_name: r for r in C.canon_package(parsed).collect()}
    assert pkg["a"].num_releases == 3 and pkg["a"].num_requires_dist == 2
    assert pkg["b"].num_releases == 4
    urls = sorted((r.pkg_name, r.url_type, r.url) for r in C.canon_url(parsed).collect())
    # a list of project_urls gives no rows; home/docs rows stay, even NULL ones
    assert urls == [("a", "docs_url", None), ("a", "home_page", "https://h.org/p"),
                    ("b", "Source", "https://github.com/o/r"), ("b", "docs_url", None),
                    ("b", "home_page", None)]
    kws = [(r.pkg_name, r.keyword) for r in C.canon_keyword(parsed).orderBy("ord", "pos").collect()]
    assert kws == [("b", "k1"), ("b", "k2")]   # a JSON list of keywords gives none


def test_requirements(spark):
    raw = _raw(spark, [
        ("nullmap", {"info": _info(), "requires": None}),
        ("emptymap", {"info": _info(), "requires": {}}),
        ("p", {"info": _info(), "requires": {
            "nullval": None,
            "norel": {"releases": [], "requirement": ">1"},
            "two": {"releases": ["1.9", "1.10"], "requirement": ">=1"}}}),
    ])
    got = {r.required_pkg_name: (r.pkg_name, r.num_match_dist, r.requirement_string,
                                 r.newest_dist, r.oldest_dist)
           for r in C.canon_requirement(parse_raw(raw)).collect()}
    assert got == {"nullval": ("p", 0, "nullval", None, None),
                   "norel": ("p", 0, ">1", None, None),
                   "two": ("p", 2, ">=1", "1.9", "1.10")}


def test_emails(spark):
    raw = _raw(spark, [
        ("p", {"info": _info(author=None, author_email="Jane D <j@x.org>, Bob <b@y.org>",
                             maintainer="M", maintainer_email="a@x.org, b@y")}),
        ("q", {"info": _info(author="A", author_email="", maintainer_email=None)}),
    ])
    got = sorted(tuple(r) for r in C.canon_email(parse_raw(raw)).collect())
    assert got == sorted([
        ("p", "Jane D", "j@x.org", "j@x.org", "x.org", "org", "author"),
        ("p", "M", "a@x.org, b@y", "a@x.org", "x.org", "org", "maintainer"),
        ("p", "M", "a@x.org, b@y", " b@y", "y", None, "maintainer"),
        ("q", "A", "", "", "", None, "author"),
    ])


def test_license_first_occurrence_matches_running_count(spark):
    lic = ["MIT", "BSD", "MIT", None, "GPL", "MIT", "BSD", "UNKNOWN"]
    raw = _raw(spark, [(f"p{i}", {"info": _info(license=l)}) for i, l in enumerate(lic)])
    pkg = C.canon_package(parse_raw(raw), keep_ord=True).repartition(3)
    got = {r.pkg_name: r.license for r in C.canon_license(pkg).collect()}
    seen: dict = {}
    want = {}
    for i, l in enumerate(lic):
        seen[l] = seen.get(l, 0) + 1
        want[f"p{i}"] = None if seen[l] < 2 else l
    assert got == want


def test_parsed_fields_roundtrip(spark):
    raw = _raw(spark, [("p", {"num_releases": 2, "info": _info(
        name="n", project_urls={"Source": "s"}, keywords="kw", author="a")})])
    r = C.parsed_fields(parse_raw(raw)).first()
    assert (r.info_name, r.pu_source, r.keywords, r.author, r.num_releases) == ("n", "s", "kw", "a", 2)


def test_canonicalize_outputs_five_tables(spark):
    raw = _raw(spark, [("p", {"info": _info(license="MIT", keywords="a b")})])
    canon = C.canonicalize(parse_raw(raw), keyword_threshold=0)
    assert sorted(canon) == sorted(["latest_package", "latest_requirement", "latest_url",
                                    "latest_keyword", "latest_email"])
    assert sorted(r.keyword for r in canon["latest_keyword"].collect()) == ["a", "b"]
    assert canon["latest_package"].where(F.col("license").isNull()).count() == 1


def test_counts_round_half_even_like_sql_casts(spark):
    raw = _raw(spark, [(f"p{i}", {"num_releases": x, "info": _info()})
                       for i, x in enumerate([2.5, 3.5, 3.4, 7, None])])
    got = [r.num_releases for r in C.canon_package(parse_raw(raw)).orderBy("pkg_name").collect()]
    assert got == [2, 4, 3, 7, None]
