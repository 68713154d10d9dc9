"""Column functions: tables of written-out inputs and expected outputs."""

from __future__ import annotations

import pytest

from propgraph.functions import (clean_keyword, github_parts, key_id, keyword_tokens,
                                 not_both_blank, person_and_email, py_strip, url_features)
from pyspark.sql import functions as F

N = None
# url, domain, top-level domain, path, repository, account
URLS = [
    (N, N, N, N, N, N),
    ("", N, N, N, N, N),
    ("   http://lead.blank/x", "lead.blank", "blank", "/x", N, N),
    ("http://a.com/x;p?q", "a.com", "com", "/x", N, N),
    ("mailto:a@b.c", N, N, "a@b.c", N, N),
    ("localhost:8080/x", N, N, "8080/x", N, N),
    ("http:/a", N, N, "/a", N, N),
    ("//net/p", "net", N, "/p", N, N),
    ("https://github.com/", "github.com", "com", "/", N, ""),
    ("https://github.com", "github.com", "com", N, N, N),
    ("https://github.com/a/b/tree/main", "github.com", "com", "/a/b/tree/main", "a/b", "a"),
    ("https://github.com/o//r", "github.com", "com", "/o/r", "o/r", "o"),
    ("https://www.github.com/a/b", "www.github.com", "com", "/a/b", N, N),
    ("https://github.com/tiangolo/typer.git", "github.com", "com", "/tiangolo/typer.git", "angolo/typer", "angolo"),
    ("http://user@h_x.com:80//a///b5;p?q#f", "user@h_x.com:80", "com:80", "/a//b5", N, N),
    ("git+https://github.com/o/r.git;x", "github.com", "com", "/o/r.git;x", "o/r.git;x", "o"),
    ("HTTP://UP.com/A;b", "UP.com", "com", "/A", N, N),
    ("github.com/no/scheme", N, N, "github.com/no/scheme", N, N),
    ("UNKNOWN", N, N, "UNKNOWN", N, N),
    ("https://github.com/acct5/", "github.com", "com", "/acct5/", N, "acct5"),
    ("https://github.com/...", "github.com", "com", "/...", N, N),
    ("https://github.com/x.zip/", "github.com", "com", "/x.zip/", N, "x.zip"),
    ("ftp://h.org/d/f;type=a", "h.org", "org", "/d/f", N, N),
    ("https://h.org/a\tb\nc", "h.org", "org", "/abc", N, N),
    ("http://h.org/;a/b;c", "h.org", "org", "/;a/b", N, N),
    ("http://[bad/x", N, N, N, N, N),
    ("http://[::1]:8/x", "[::1]:8", N, "/x", N, N),
]


def test_urls(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "i int, url string")
    f = df.withColumn("f", url_features("url")).withColumn("g", github_parts("f.domain", "f.path"))
    got = {r.i: (r.domain, r.top_level_domain, r.path, r.github_repo, r.github_account)
           for r in f.select("i", "f.*", "g.*").collect()}
    for i, (url, *want) in enumerate(URLS):
        assert got[i] == tuple(want), url


def test_url_regexes_appear_once(spark):
    df = spark.createDataFrame([("http://a.b/c",)], "url string")
    plan = (df.withColumn("f", url_features("url")).select("f.*")
            ._jdf.queryExecution().optimizedPlan().toString())
    assert sum(plan.count(x) for x in ("regexp_replace(", "regexp_extract(", "RLIKE")) <= 8


# email text, person -> name, address
PEOPLE = [
    ("<a@b>", N, "", "a@b"), ("x <>", N, N, "x <>"), ("x <> y <z>", "p", "p", "z"),
    ("no", N, N, "no"), ("Ann\nB <a@b>", N, N, "Ann\nB <a@b>"), ("Ann B\n <a@b>", N, "Ann B", "a@b"),
    ("x <<a>", "P <x>", "x", "<a"), ("< >", "", "", ""),
    ("Jane D <j@x.org>, Bob <b@y.org>", "Cara", "Cara", "j@x.org"),
    ("Jane D <j@x.org>", "Who <w@x>", "Jane D", "j@x.org"), ("a@x.org, b@y.net", N, N, "a@x.org, b@y.net"),
    ("", "", "", ""), ("x y <c@d>", N, "x y", "c@d"),
]


def test_people(spark):
    df = spark.createDataFrame([(i, p[1], p[0]) for i, p in enumerate(PEOPLE)], "i int, person string, email string")
    got = {r.i: (r.person_name, r.email_record) for r in
           df.select("i", person_and_email("person", "email").alias("x")).select("i", "x.*").collect()}
    for i, (email, person, *want) in enumerate(PEOPLE):
        assert got[i] == tuple(want), (email, person)


KEYWORDS = [
    ('["a", "b"]', ["a", "b"]), ("a,b", ["a", "b"]), ("a b", ["a", "b"]), (" A ,, b", ["a", "b"]),
    ("[]", []), ("", []), ("x  y", ["x", "y"]), ('["Big Data"]', ["big", "data"]),
    (" Tab\tkw ,z", ["tab\tkw", "z"]), ('"one"', ["one"]), ("[x],[Y]", ["x", "y"]),
]


def test_keywords(spark):
    df = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(KEYWORDS)], "i int, k string")
    rows = (df.select("i", F.posexplode(keyword_tokens("k")).alias("pos", "tok"))
            .select("i", "pos", clean_keyword("tok").alias("kw")).where("kw != ''").orderBy("i", "pos").collect())
    for i, (text, want) in enumerate(KEYWORDS):
        assert [r.kw for r in rows if r.i == i] == want, text


@pytest.mark.parametrize("s", ["  \x1c a b\t　", "", "a", "\n\x85x\xa0"])
def test_py_strip_unicode_blanks(spark, s):
    assert spark.createDataFrame([(s,)], "s string").select(py_strip("s").alias("x")).first().x == s.strip()


def test_key_id_null_rules(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a|b", "c"), ("a", "b|c"), (None, None)],
                               "a string, b string")
    rows = df.select(key_id("a", "b").alias("id"), key_id("a").alias("one")).collect()
    ids = [r.id for r in rows]
    assert ids[0] == ids[1]                 # NULL and '' parts give one id
    assert ids[2] == ids[3]                 # '|' inside a part is not escaped
    assert all(i is not None for i in ids)
    assert rows[0].one == "null" and rows[4].one == "null"


def test_not_both_blank_never_null(spark):
    df = spark.createDataFrame([(None, None), ("", None), (None, "x"), ("a", ""), ("", "")],
                               "a string, b string")
    got = [r.ok for r in df.select(not_both_blank("a", "b").alias("ok")).collect()]
    assert got == [False, False, True, True, False]
