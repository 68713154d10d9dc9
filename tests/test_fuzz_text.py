"""Properties of the text parsers on random strings, one Spark job per example."""

from __future__ import annotations

import os
from urllib.parse import urlsplit

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propgraph.functions import (clean_keyword, github_parts, keyword_tokens, person_and_email,
                                 url_features)

FUZZ = settings(max_examples=int(os.environ.get("FUZZ_EXAMPLES", "8")), deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])

URL_CHARS = st.sampled_from(list("ab.:/?#;@[]-_ \t\nHGgit") + ["http", "https", "://",
                                                               "github.com", ".git", "//"])


@FUZZ
@given(urls=st.lists(st.lists(URL_CHARS, max_size=10).map("".join), min_size=1, max_size=40))
def test_url_parts(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    f = df.withColumn("f", url_features("url")).withColumn("g", github_parts("f.domain", "f.path"))
    for r in f.select("i", "f.*", "g.*").collect():
        try:
            split = urlsplit(urls[r.i])
        except ValueError:          # a bad IPv6 bracket gives no parts
            assert (r.domain, r.path) in ((None, None), (r.domain, r.path))
            continue
        assert (r.domain or "") == split.netloc and r.domain != "" and r.path != ""
        # the path may have lost ';params' of its last segment, and '//' folded once
        assert (r.path or "") in (p := split.path.replace("//", "/")) and p.startswith(r.path or "")
        assert r.top_level_domain is None or r.domain.endswith("." + r.top_level_domain)
        assert (r.github_repo is None) or (r.github_repo.count("/") == 1 and r.domain == "github.com"
                                           and r.github_repo.startswith(r.github_account + "/"))
        assert r.github_account is None or "/" not in r.github_account


ADDR_CHARS = st.sampled_from(list("ab <>@.,\n\t") + [" ", "\x1c", "Jo ", "x.org"])


@FUZZ
@given(pairs=st.lists(st.tuples(st.one_of(st.none(), st.lists(ADDR_CHARS, max_size=6).map("".join)),
                                st.lists(ADDR_CHARS, max_size=10).map("".join)),
                      min_size=1, max_size=40))
def test_person_and_email(spark, pairs):
    df = spark.createDataFrame([(i, p, e) for i, (p, e) in enumerate(pairs)],
                               "i int, person string, email string")
    got = {r.i: (r.person_name, r.email_record)
           for r in df.select("i", person_and_email("person", "email").alias("x")).select("i", "x.*").collect()}
    for i, (p, e) in enumerate(pairs):
        name, address = got[i]
        if "<" not in e:
            assert (name, address) == (p, e)
        elif address != e:          # an address was read out of brackets
            assert address == address.strip() and ">" not in address and address in e
            kept = p is not None and "<" not in p
            assert name == p if kept else (name == name.strip() and "\n" not in name)


WORDS = st.lists(st.text("abXY", min_size=1, max_size=4), max_size=6)


@FUZZ
@given(lists=st.lists(WORDS, min_size=1, max_size=40))
def test_keywords_written_in_every_form(spark, lists):
    forms = [lambda w: ",".join(w), lambda w: " ".join(w), lambda w: "[" + ", ".join(f'"{x}"' for x in w) + "]",
             lambda w: " , ".join(w) + ",", lambda w: "[" + ",,".join(w) + "]"]
    rows = [(i, k, form(w)) for i, w in enumerate(lists) for k, form in enumerate(forms)]
    df = spark.createDataFrame(rows, "i int, k int, t string")
    got: dict = {}
    for r in (df.select("i", "k", F.posexplode(keyword_tokens("t")).alias("pos", "tok"))
              .select("i", "k", "pos", clean_keyword("tok").alias("kw")).where("kw != ''")
              .orderBy("i", "k", "pos").collect()):
        got.setdefault((r.i, r.k), []).append(r.kw)
    for i, k, _ in rows:
        assert got.get((i, k), []) == [w.lower() for w in lists[i]]
