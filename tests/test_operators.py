"""Operators against brute force, with skewed keys and shuffled partitions."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from propgraph.operators import (check_graph, distinct_on, drop_first_occurrences, kth_occurrence,
                                 merge_children, null_first_occurrence, population)


def test_distinct_on_picks_smallest_row_nulls_first(spark):
    rows = [("k", "b", 1), ("k", None, 5), ("k", "a", 0), ("j", "z", 2), (None, "x", 1),
            (None, "w", 9)]
    df = spark.createDataFrame(rows, "k string, a string, n int")
    for parts in (1, 3, 7):
        got = sorted(distinct_on(df.repartition(parts), ["k"]).collect(), key=repr)
        assert sorted(map(tuple, got), key=repr) == sorted(
            [("k", None, 5), ("j", "z", 2), (None, "w", 9)], key=repr)
    once = distinct_on(df, ["k"])
    assert sorted(once.collect(), key=repr) == sorted(distinct_on(once, ["k"]).collect(), key=repr)


def _skewed_tokens(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for ord_ in rnd.sample(range(10 * n), n // 3):
        for pos in range(3):
            # one keyword holds about a third of all rows
            kw = "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(40)}"
            rows.append((ord_, pos, f"pkg{ord_}", kw))
    return rows


def test_drop_first_occurrences_equals_running_count(spark):
    rows = _skewed_tokens()
    df = spark.createDataFrame(rows, "ord long, pos int, pkg_name string, keyword string")
    counts = Counter()
    want = []
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        counts[r[3]] += 1
        if counts[r[3]] > 25:
            want.append(r)
    for buckets in (None, 1, 4, 13):
        got = drop_first_occurrences(df.repartition(5), "keyword", ["ord", "pos"], 25, buckets)
        assert sorted(map(tuple, got.collect())) == sorted(want), buckets


def test_drop_first_occurrences_matches_window(spark):
    df = spark.createDataFrame(_skewed_tokens(1200, 3),
                               "ord long, pos int, pkg_name string, keyword string")
    w = Window.partitionBy("keyword").orderBy("ord", "pos")
    brute = df.withColumn("rn", F.row_number().over(w)).where("rn > 10").drop("rn")
    for buckets in (6, None):
        got = drop_first_occurrences(df, "keyword", ["ord", "pos"], 10, buckets)
        assert sorted(got.collect()) == sorted(brute.collect())


def test_kth_occurrence_limits_groups_before_the_shuffle(spark, tmp_path):
    rows = _skewed_tokens(1200, 3)
    spark.createDataFrame(rows, "ord long, pos int, pkg_name string, keyword string").write.parquet(str(tmp_path / "t"))
    tokens = spark.read.parquet(str(tmp_path / "t"))
    kth = kth_occurrence(tokens, "keyword", ["ord", "pos"], 10)
    want = {}
    for r in sorted(rows):
        want.setdefault(r[3], []).append((r[0], r[1]))
    assert {r.keyword: tuple(r.at) for r in kth.collect()} == {k: v[9] for k, v in want.items() if len(v) > 9}
    plan = drop_first_occurrences(tokens, "keyword", ["ord", "pos"], 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "Scan ExistingRDD" not in plan
    # more than the limit of such windows: by ranges, with the same rows
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(limit, "5")
    try:
        got = drop_first_occurrences(tokens, "keyword", ["ord", "pos"], 10).collect()
    finally:
        spark.conf.unset(limit)
    assert sorted(got) == sorted(drop_first_occurrences(tokens, "keyword", ["ord", "pos"], 10).collect())


def test_null_first_occurrence_with_hot_value(spark):
    rnd = random.Random(1)
    vals = [rnd.choice(["hot"] * 5 + ["a", "b", None, "c"]) for _ in range(500)]
    ords = rnd.sample(range(5000), 500)
    df = spark.createDataFrame(list(zip(ords, vals)), "ord long, v string").repartition(4)
    got = {r.ord: r.v for r in null_first_occurrence(df, "v", "ord").collect()}
    first = {}
    for o, v in sorted(zip(ords, vals)):
        first.setdefault(v, o)
    want = {o: (None if first.get(v) == o else v) for o, v in zip(ords, vals)}
    assert got == want


def test_merge_children_keeps_left_join_multiplicity(spark):
    a = spark.createDataFrame([("x", "y", "l1"), ("x", "y", "l1b"), ("p", "q", "l2")],
                              "from_id string, to_id string, link_id string")
    b = spark.createDataFrame([("x", "y", "m1"), ("r", "s", "m2"), ("r", "s", "m3")],
                              "from_id string, to_id string, link_id string")
    out = merge_children([a, b], ["from_id", "to_id"],
                         lambda: [F.col("t1.link_id").alias("link_id"), "from_id", "to_id"],
                         distinct=False)
    got = sorted(map(tuple, out.collect()), key=repr)
    # population LEFT JOIN a LEFT JOIN b: x,y -> 2*1, p,q -> 1*1, r,s -> 1*2
    assert got == sorted([("l1", "x", "y"), ("l1b", "x", "y"), ("l2", "p", "q"),
                          (None, "r", "s"), (None, "r", "s")], key=repr)
    pop = population([a, b], ["from_id", "to_id"])
    assert pop.count() == 3


def test_merge_children_distinct_picks_whole_rows(spark):
    a = spark.createDataFrame([("n1", None, "e"), ("n1", "", "e"), ("n2", "x", None)],
                              "node_id string, name string, email string")
    b = spark.createDataFrame([("n1", "bob", "f"), ("n3", "c", "g")],
                              "node_id string, name string, email string")
    out = merge_children([a, b], ["node_id"], lambda: [
        "node_id", F.coalesce("t1.name", "t2.name").alias("name"),
        F.coalesce("t1.email", "t2.email").alias("email")], distinct=True)
    got = sorted(map(tuple, out.collect()))
    assert got == [("n1", "bob", "e"), ("n2", "x", None), ("n3", "c", "g")]


def test_check_graph_finds_orphans(spark):
    nodes = {"url": spark.createDataFrame([("u1",), ("u2",)], "node_id string"),
             "dom": spark.createDataFrame([("d1",)], "node_id string")}
    links = {"hosted": spark.createDataFrame([("l1", "u1", "d1"), ("l2", "u2", "UNKNOWN"),
                                              ("l3", "u2", "UNKNOWN")],
                                             "link_id string, from_id string, to_id string")}
    rows = {r.side: r for r in check_graph(nodes, links, {"hosted": ("url", "dom")}).collect()}
    assert (rows["from_id"].n_links, rows["from_id"].n_ids, rows["from_id"].n_orphans) == (3, 2, 0)
    assert (rows["to_id"].n_nodes, rows["to_id"].n_ids, rows["to_id"].n_orphans) == (1, 2, 1)
    assert rows["from_id"].ok and not rows["to_id"].ok
