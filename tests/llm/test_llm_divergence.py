"""Source divergence: the dense definition in plain Python, and the SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gate import compare, duck
from propgraph.llm import divergence as D
from propgraph.llm import queries as Q

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
DDL = "doc_id bigint, text string, lang string, source string"


def dense(rows, top=200, min_docs=3):
    """Every share of every kept term in every group, as the contract states it."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        kept = [t for t, n in Counter(t for d in mine for t in set(d[2])).items() if n >= min_docs]
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in set(kept))
        whole = sum(counts.values(), Counter())

        def share(c):
            size = sum(c.values()) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // size for t in kept}

        f = lambda p, q: (p - q) ** 2 // q
        shares, all_shares = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(sum(f(p[t], q[t]) for t in kept), o) for o, q in shares.items() if o != s]
            terms = [(f(p[t], all_shares[t]), t) for t in kept if counts[s][t] and p[t] > all_shares[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)}
    return out


def result(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, n, sources, words=40):
    r = random.Random(seed)
    pool = [r.choice(["w", "W", "é", "Ö", "ß", "漢"]) + "".join(r.choice("abé") for _ in range(r.randint(0, 3)))
            for _ in range(words)]
    rows = []
    for i in range(n):
        text = r.choice(["  ", ", ", "1", "\n", "_"]).join(r.choice(pool) for _ in range(r.randint(0, 30)))
        rows.append((i, r.choice([text, text, text, "", None]), r.choice(["en", "de", None, ""]),
                     r.choice([f"s{k}" for k in range(sources)] + ["hot"] * sources + [None])))
    return rows


@pytest.mark.parametrize("seed, n, sources, block", [(1, 300, 4, 1 << 24), (2, 300, 4, 25), (3, 120, 30, 900)])
def test_against_the_dense_definition(spark, seed, n, sources, block):
    rows = made(seed, n, sources)
    rows += [(9000, "long " * 20_000 + "Tail", "en", "hot")] * 3     # very long, repeated rows
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS term", "2 AS n", "'x' AS p").repartition(5)
    assert result(D.audit_sources(df, block_bytes=block)) == dense(rows)


@pytest.mark.parametrize("pairs", [1, 7, 1 << 20])
def test_corrections_in_portions(monkeypatch, pairs):
    monkeypatch.setattr(D, "PAIRS", pairs)
    r, f = random.Random(7), lambda p, q: (p - q) ** 2 // q
    terms = [[(k, r.randint(1, 10 ** 9), 2 + k % 5) for k in r.sample(range(12), size)] for size in (2, 9, 5, 12, 2)]
    want, got = Counter(), Counter()
    for held in terms:
        for a, p, p0 in held:
            for b, q, q0 in held:
                if a != b:
                    want[a * 12 + b] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    place, p, p0 = np.array([x for held in terms for x in held]).T
    for keys, values in D._corrected(place, p, p0, np.array([len(t) for t in terms]), 12):
        got.update(dict(zip(keys.tolist(), values.tolist())))
    assert got == want


def test_words_of_awkward_texts():
    texts = ["Ab c", "", "d", "é-É x1y", " ", "last"]
    parts = [pa.array(texts[:3]), pa.array(["skip", *texts[3:]])[1:]]
    words, sizes = D._words(parts)
    assert [w.decode() for w in words.to_pylist()] == ["ab", "c", "d", "é", "É", "x", "y", "last"]
    assert sizes.tolist() == [2, 0, 1, 4, 0, 1]
    assert [len(x) for x in D._words([pa.array([""])])] == [0, 1]


def test_no_kept_terms_and_empty_table(spark):
    rows = [(1, "a b", "en", "s"), (2, "c", "en", "t"), (3, None, None, None)]
    assert result(D.audit_sources(spark.createDataFrame(rows, DDL))) == {
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)}
    assert result(D.audit_sources(spark.createDataFrame([], DDL))) == set()


def test_large_counts_stay_exact(spark):
    count, total = 3 * 10 ** 13, 10 ** 14 + 7
    row = spark.createDataFrame([(count, total, 1000)], "c bigint, n bigint, v bigint")
    share = row.select(D._share(row["c"], row["n"], row["v"])).collect()[0][0]
    assert share == 1 + 10 ** 9 * (count + 1) // (total + 1000)


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    r = compare(spark, sf, "op12_divergence", Q.op12_divergence, Q.oracle_sql()["op12_divergence"], duck(sf))
    assert r["status"] == "match", r
