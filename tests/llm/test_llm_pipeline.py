"""The pipeline against its stages in plain Python, and its queries against SQL."""

from __future__ import annotations

import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from gate import compare, duck
from propgraph.llm import queries as Q
from propgraph.llm import simhash, toxicity
from test_llm_decontaminate import slow_doc
from test_llm_dedup import slow_lines
from test_llm_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def slow_pipeline(spark, docs):
    """(doc_id, text) after every stage; the scorer is trained once more, which is deterministic."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    scorer = toxicity.fit_toxicity(docs, Q.table(spark, SF, "labels"))
    out = [rows := [r for r, s in zip(rows, scorer.scores([t for _, t in rows])) if s < 0.5]]
    out.append(rows := [(d, t) for d, t, *_ in slow_lines(rows)])
    smallest = slow_components({d: slow_fingerprint(t) for d, t in rows}, 4)
    out.append(rows := [(d, t) for d, t in rows if smallest[d] == d])
    items = [(r.item_id, r.text) for r in Q.table(spark, SF, "benchmark").collect()]
    out.append([(d, t) for d, t in rows if not slow_doc(t, items)[3]])
    return out


def test_stages_against_brute_force(spark):
    docs = Q.table(spark, SF, "documents")
    want = slow_pipeline(spark, docs)
    now = docs
    for (name, stage), rows in zip(P.STAGES, want):
        now = stage(spark, now, SF)
        assert now.columns == docs.columns and now.schema["n_chars"] == docs.schema["n_chars"], name
        got = sorted((r.doc_id, r.text or "") for r in now.collect())
        assert got == sorted((d, t or "") for d, t in rows), name
    assert len(want[-1]) <= len(want[2]) <= len(want[1]) == len(want[0]) < docs.count()
    lib = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_path())
    coded = P.STAGES[4][1](spark, now, SF)
    assert coded.columns == [*docs.columns, *P.TOKENS]
    last = {r.doc_id: (r.text or "", r.ids, r.decoded) for r in coded.collect()}
    ids = {d: lib.encode(t or "", add_bos=True, add_eos=True) for d, t in want[-1]}
    assert last == {d: (t or "", ids[d], lib.decode(ids[d])) for d, t in want[-1]}
    ran = {r.doc_id: (r.text or "", r.ids, r.decoded) for r in P.run(spark, SF).collect()}
    assert ran == last


def test_near_duplicates_keep_one_row_of_a_group(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(30)) for w in "abcd")
    given = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (3, b, "x"), (5, a, "x"), (5, c, "x"), (5, b, "x"),
             (None, a, "x"), (None, d, "x"), (None, d, "x"), (7, None, "x"), (8, "", "x"), (9, None, "x")]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
    got = [tuple(r) for r in P.simhash_stage(spark, docs, SF).collect()]
    assert sorted([r[:2] for r in got], key=str) == sorted([(1, a), (3, b), (5, c), (None, d), (7, None)], key=str)
    alone = docs.where("doc_id = 5")
    assert {r.text for r in P.simhash_stage(spark, alone, SF).collect()} == {a, b, c}


def test_columns_named_like_tokens_are_kept(spark):
    docs = spark.createDataFrame([(1, "one two", "x", "y"), (2, None, "x", "y")],
                                 "doc_id long, text string, ids string, _ids string")
    out = P.sentencepiece_stage(spark, docs, SF)
    assert out.columns == ["doc_id", "text", "__ids", "_ids", *P.TOKENS]
    assert sorted((r.doc_id, r.text, r["__ids"], r["_ids"], r.decoded) for r in out.collect()) == [
        (1, "one two", "x", "y", "one two"), (2, None, "x", "y", "")]


def test_stages_take_extra_clashing_columns_nulls_and_no_rows(spark):
    names = ["score", "items", "n_words", "n_lines", "_row", "fp", "contaminated", "a.b"]
    docs = Q.table(spark, SF, "documents").limit(40).withColumns({c: F.lit("x") for c in names})
    nulls = docs.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema])
    for frame in (docs.unionByName(nulls).unionByName(docs.limit(3)), docs.limit(0)):
        for name, stage in P.STAGES[:4]:
            out = stage(spark, frame, SF)
            assert out.columns == frame.columns, name
            assert all(r["a.b"] in ("x", None) for r in out.collect()), name
        assert P.STAGES[4][1](spark, frame, SF).count() == frame.count()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", list(Q.oracle_sql()))
def test_queries_match_sql(spark, con, key):
    r = compare(spark, SF, key, E.queries()[key], E.oracle_sql()[key], con)
    assert r["status"] == "match", r


def test_queries_without_sql_cover_their_tables(spark):
    n = Q.table(spark, SF, "documents").count()
    for key in ("op1_sharding", "op2_simhash", "op8_toxicity", "op9_sentencepiece"):
        assert E.queries()[key](spark, SF).count() == n, key
    rows = {r.doc_id: r.text for r in Q.table(spark, SF, "documents").collect()}
    want = slow_components({d: simhash.fingerprint(t) for d, t in rows.items()}, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in E.queries()["op2_simhash"](spark, SF).collect()}
    assert got == {d: (f"{slow_fingerprint(t):016x}", want[d]) for d, t in rows.items()}
    found = E.queries()["op6_secret_scan"](spark, SF.replace("0.001", "0.01")).collect()
    assert found and {r.kept for r in found} == {True, False}
