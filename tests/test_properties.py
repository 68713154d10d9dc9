"""Property tests (hypothesis) against plain-Python models, few examples each
because every example runs Spark jobs."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from propgraph.operators import distinct_on, drop_first_occurrences, null_first_occurrence

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# keys drawn from a tiny alphabet, so some key holds a large share of rows
KEYS = st.sampled_from(["hot", "hot", "hot", "a", "b", None])


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.integers(0, 3)), min_size=1, max_size=120),
       k=st.integers(0, 6), buckets=st.none() | st.integers(1, 9), parts=st.integers(1, 5))
@example(rows=[(None, 0), (None, 0)], k=1, buckets=None, parts=1)
@example(rows=[(None, 0)], k=0, buckets=1, parts=1)      # a NULL key is a key
def test_drop_first_occurrences_model(spark, rows, k, buckets, parts):
    data = [(i, j, f"p{i}", key) for i, (key, j) in enumerate(rows)]
    df = spark.createDataFrame(data, "ord long, pos int, pkg_name string, keyword string")
    got = drop_first_occurrences(df.repartition(parts), "keyword", ["ord", "pos"], k, buckets)
    seen: Counter = Counter()
    want = []
    for r in sorted(data, key=lambda r: (r[0], r[1])):
        seen[r[3]] += 1
        if seen[r[3]] > k:
            want.append(r)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@SETTINGS
@given(vals=st.lists(KEYS, min_size=1, max_size=80), parts=st.integers(1, 5))
def test_null_first_occurrence_model(spark, vals, parts):
    data = [(i * 7 % 101, v) for i, v in enumerate(vals)]       # unique, shuffled ords
    df = spark.createDataFrame(data, "ord long, v string").repartition(parts)
    got = {r.ord: r.v for r in null_first_occurrence(df, "v", "ord").collect()}
    first: dict = {}
    for o, v in sorted(data):
        first.setdefault(v, o)
    assert got == {o: (None if first[v] == o else v) for o, v in data}


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.one_of(st.none(), st.text("xy", max_size=2)),
                               st.integers(0, 2)), min_size=1, max_size=60),
       parts=st.integers(1, 5))
def test_distinct_on_model_and_idempotent(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, a string, n int").repartition(parts)
    got = sorted(map(tuple, distinct_on(df, ["k"]).collect()), key=repr)
    best: dict = {}
    for k, a, n in rows:
        cand = (a is not None, a or "", n)                        # NULLs first, then value
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, a, n))
    assert got == sorted((v[1] for v in best.values()), key=repr)
    again = distinct_on(distinct_on(df, ["k"]), ["k"])
    assert sorted(map(tuple, again.collect()), key=repr) == got


CHILD_ROWS = st.lists(st.tuples(st.sampled_from(["n1", "n1", "n2", "n3"]),
                                st.one_of(st.none(), st.sampled_from(["", "a", "b"]))),
                      max_size=12)


def _population_left_join(children):
    keys = sorted({k for rows in children for k, _ in rows})
    out = []
    for k in keys:
        combos = [[]]
        for rows in children:
            match = [v for kk, v in rows if kk == k] or [None]
            combos = [c + [v] for c in combos for v in match]
        out += [(k, *c) for c in combos]
    return out


@SETTINGS
@given(a=CHILD_ROWS, b=CHILD_ROWS, parts=st.integers(1, 4))
def test_merge_children_model(spark, a, b, parts):
    from pyspark.sql import functions as F
    from propgraph.operators import merge_children
    if not a and not b:
        return
    dfs = [spark.createDataFrame(rows, "node_id string, v string").repartition(parts)
           for rows in (a, b)]
    sel = lambda: ["node_id", F.col("t1.v").alias("v1"), F.col("t2.v").alias("v2")]
    # multiplicity kept: population LEFT JOIN a LEFT JOIN b
    got = sorted(map(tuple, merge_children(dfs, ["node_id"], sel, distinct=False).collect()),
                 key=repr)
    assert got == sorted(_population_left_join([a, b]), key=repr)
    # one row per key: each child's smallest row (NULL first), then combined
    pick = lambda rows, k: min((v for kk, v in rows if kk == k),
                               key=lambda v: (v is not None, v or ""), default=None)
    keys = sorted({k for k, _ in a + b})
    got = sorted(map(tuple, merge_children(dfs, ["node_id"], sel, distinct=True).collect()))
    assert got == [(k, pick(a, k), pick(b, k)) for k in keys]


IDS = st.sampled_from(["a", "b", "c", "d", "hot", "hot"])


@SETTINGS
@given(links=st.lists(st.tuples(IDS, IDS), min_size=1, max_size=30),
       src=st.lists(IDS, max_size=6), dst=st.lists(IDS, max_size=6))
def test_check_graph_model(spark, links, src, dst):
    from propgraph.operators import check_graph
    nodes = {"s": spark.createDataFrame([(i,) for i in src], "node_id string"),
             "t": spark.createDataFrame([(i,) for i in dst], "node_id string")}
    link = spark.createDataFrame([(f"l{i}", f, t) for i, (f, t) in enumerate(links)],
                                 "link_id string, from_id string, to_id string")
    got = {r.side: tuple(r)[3:] for r in check_graph(nodes, {"x": link}, {"x": ("s", "t")}).collect()}
    for side, col, ids in (("from_id", 0, src), ("to_id", 1, dst)):
        ends = {l[col] for l in links}
        orphans = ends - set(ids)
        assert got[side] == (len(links), len(ids), len(ends), len(orphans), not orphans), side
