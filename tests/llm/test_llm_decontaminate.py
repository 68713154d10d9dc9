"""Winnowing and contamination against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from propgraph.llm import decontaminate as D


def slow_words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow_doc(text, items, window=13):
    w = slow_words(text)
    hit, found = set(), set()
    for item, t in items:
        iw = slow_words(t)
        size = min(window, len(iw))
        grams = {tuple(iw[s:s + size]) for s in range(len(iw) - size + 1)} if size else set()
        for s in range(len(w) - size + 1 if size else 0):
            if tuple(w[s:s + size]) in grams:
                hit |= set(range(s, s + size))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def cases():
    r = random.Random(8)
    vocab = ["the", "of", "Éa", "x1", "a", "b", "ñu", "9", "k", "zz"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 2, 5, 12, 13, 14, 40])))) for i in range(40)]
    items += [(100, None), (101, "..."), (None, "only by null id the words one two three four five six seven"),
              (7, "same id another text of some words here now"), (102, items[3][1])]
    docs = []
    for i in range(120):
        words = [r.choice(vocab + [f"f{k}" for k in range(60)]) for _ in range(r.choice([0, 3, 30, 300]))]
        for _ in range(r.choice([0, 1, 3])):
            src = slow_words(r.choice(items)[1])
            a = r.randint(0, max(0, len(src) - 1))
            at = r.randint(0, len(words))
            words[at:at] = src[a:a + r.choice([5, 13, 14, 40])]
        docs.append((i, r.choice([" ", "\n", "--", "_"]).join(words)))
    docs += [(None, None), (None, ""), (3, docs[5][1]), (3, docs[5][1]),
             (200, "zq " * 50000 + " ".join(slow_words(items[-3][1])) + " zq" * 50000)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "c") for d, t in docs], "doc_id bigint, text string, n_words string"),
            spark.createDataFrame(items, "item_id bigint, text string"))


def check(spark, docs, items, **options):
    d, b = frames(spark, docs, items)
    got = D.with_verdict(D.find_contamination(d, b, **options)).collect()
    have = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got)
    want = Counter()
    for doc, t in docs:
        n, hit, found, bad = slow_doc(t, items)
        want[(doc, n, hit, tuple(found), bad)] += 1
    assert have == want


def test_against_brute_force(spark, cases):
    check(spark, *cases)
    assert sum(slow_doc(t, cases[1])[3] for _, t in cases[0]) > 20


def test_benchmark_in_several_blocks(spark, cases):
    check(spark, *cases, block_bytes=900)


def test_long_documents_in_chunks(spark, cases, monkeypatch):
    number = {w: i + 1 for i, w in enumerate(sorted({x for _, t in cases[1] for x in slow_words(t)}))}
    bench = D.Benchmark(cases[1])
    assert bench.number == {w.encode(): i for w, i in number.items()} or len(bench.number) == len(number)
    ids = [np.array([bench.number.get(w.encode(), 0) for w in slow_words(t)], np.int64) for _, t in cases[0][:120]]
    whole = [bench.spans(i) for i in ids]
    monkeypatch.setattr(D, "CHUNK", 16)
    for a, i in zip(whole, ids):
        spans, items = bench.spans(i)
        assert D.merge_spans(spans) == D.merge_spans(a[0]) and items == a[1]


def test_winnowing_guarantee():
    r = np.random.default_rng(3)
    for _ in range(300):
        shared = r.integers(1, 30, 13)
        a = np.concatenate((r.integers(1, 30, r.integers(0, 20)), shared, r.integers(1, 30, r.integers(0, 20))))
        b = np.concatenate((r.integers(1, 30, r.integers(0, 20)), shared, r.integers(1, 30, r.integers(0, 20))))
        kept = [set(D._gram_hashes(x, 5)[D.winnow(x, 5, 9)].tolist()) for x in (a, b)]
        assert kept[0] & kept[1]
    x = r.integers(1, 4, 400)
    h, at = D._gram_hashes(x, 5), D.winnow(x, 5, 9)
    for s in range(len(h) - 8):
        run = h[s:s + 9]
        assert s + 8 - int(run[::-1].argmin()) in at
    assert len(at) < len(h)


def test_empty(spark):
    d, b = frames(spark, [(1, "a b c")], [])
    assert D.with_verdict(D.find_contamination(d, b)).select("n_words", "n_hit", "contaminated").first() == (3, 0, False)
    assert D.find_contamination(d.limit(0), b).count() == 0
    assert D.find_contamination(d, b, keep=("doc_id", "text")).columns[:2] == ["doc_id", "text"]
    assert D.find_contamination(d.withColumn("s", F.struct("doc_id")), b, keep=("s",)).first()["s"].doc_id == 1
