"""Exact and line deduplication against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from propgraph.llm import exact_dedup, line_dedup


def squeeze(t: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


TEXTS = ["a b", "ab", "a\tb\n", " a  b ", None, "", " \n\x0b", "É x", "éx", "a b", "\x1cab", "z" * 200_000]


@pytest.mark.parametrize("split_rows", [256, 5])
def test_exact(spark, split_rows):
    r = random.Random(2)
    rows = [(i, r.choice(TEXTS), "k", 1) for i in range(150)]
    rows += [(i, "hot " + " " * (i % 4) + "text", "k", 1) for i in range(150, 260)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string, piece int").repartition(5)
    got = exact_dedup.exact_dedup(df, split_rows).collect()
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[squeeze(t)].append((-len(t or ""), d))
    want = [(d, min(groups[squeeze(t)])[1], len(groups[squeeze(t)]), sha(squeeze(t)),
             d == min(groups[squeeze(t)])[1]) for d, t, *_ in rows]
    assert Counter((x.doc_id, x.keep_id, x.group_size, x.text_sha256, x.kept) for x in got) == Counter(want)


@pytest.mark.parametrize("split_rows", [256, 3])
def test_exact_repeated_rows_and_null_ids(spark, split_rows):
    rows = [(4, "same")] * 9 + [(None, "same"), (None, None), (None, "")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), split_rows).collect()
    same = [x for x in got if x.text_sha256 == sha("same")]
    assert len(same) == 10 and sum(x.kept for x in same) == 1
    assert {x.keep_id for x in same} == {4} and {x.group_size for x in same} == {10}
    assert all(x.doc_id == 4 for x in same if x.kept)
    empty = [x for x in got if x.text_sha256 == sha("")]
    assert [x.group_size for x in empty] == [2, 2] and sum(x.kept for x in empty) == 1
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_sorts_texts_once_by_short_splitters(spark, monkeypatch):
    plans = []
    real = exact_dedup.checkpointed
    monkeypatch.setattr(exact_dedup, "checkpointed", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df))
    df = spark.createDataFrame([(i, f"text {i % 40}") for i in range(100)], "doc_id bigint, text string")
    assert exact_dedup.exact_dedup(df).where("kept").count() == 40
    # the windows reuse the range partitioning: no other exchange of the texts
    (plan,) = plans
    assert plan.count("rangepartitioning(lead#") == 1 and "hashpartitioning" not in plan


def slow_lines(rows, min_points=10):
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    rank = lambda d: (d is None, d or 0)
    owner = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= min_points and (k not in owner or rank(d) < rank(owner[k])):
                owner[k] = d
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_points or owner[key(x)] == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("split_lines", [2048, 3])
def test_lines(spark, split_lines):
    r = random.Random(4)
    pool = ["short", "", "  A Common Line Here ", "a common line here", "ÄÖÜ common Line", "äöü common line",
            "\tİstanbul is a LINE\r", "exactly10c", "nine char", " not trimmed here", "x" * 50000]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < .5 else f"line number {r.randint(0, 300)} of text"
                          for _ in range(r.choice([0, 1, 3, 200])))) for i in range(60)]
    rows += [(None, "a common line here\nonly null holds it"), (None, None), (3, "again\na common line here"),
             (3, "line number 7 of text"), (70, ""), (71, "a common line here"), (71, "a common line here")]
    r.shuffle(rows)
    df = spark.createDataFrame([(d, t, 9, "e") for d, t in rows],
                               "doc_id bigint, text string, n_lines int, word string").repartition(4)
    got = line_dedup.apply_bitmaps(df, line_dedup.line_bitmaps(df, split_lines=split_lines)).collect()
    have = Counter((x.doc_id, x.text or "", x.n_lines, x.n_dropped) for x in got)
    assert have == Counter(slow_lines(rows))
    assert all(x.word == "e" for x in got)


def test_line_bitmaps_are_sparse(spark):
    shared = "this line is shared by both"
    long = [f"unique line number {i}" for i in range(1000)]
    long[700] = shared
    df = spark.createDataFrame([(1, shared), (2, "\n".join(long))], "doc_id bigint, text string")
    b = line_dedup.line_bitmaps(df).collect()
    assert [(x.doc_id, [(w.word, w.bits) for w in x.keep]) for x in b] == [(2, [(10, ~(1 << 60))])]
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.apply_bitmaps(none, line_dedup.line_bitmaps(none)).count() == 0
