"""Referential checks: every link end must be a node id of its node table.

All links and both ends are checked in one pass:

1. the ends of all link tables are unioned into (link, side, node, id) and
   counted per distinct end (map-side combine: a hot id costs one row per
   partition in the shuffle);
2. the ids of all node tables are unioned into (node, id) and counted;
3. one join of the two on (node, id) (ids compared NULL-safely, as a set
   membership test would) marks the orphans, and a last small aggregate gives
   per (link, side) the rows, distinct ids and orphans.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_SCHEMA = "link string, side string, node string"


SIDES = ("from_id", "to_id")


def _ends(links: dict[str, DataFrame], subgraphs: dict[str, tuple[str, str]],
          sides: Sequence[str]) -> DataFrame:
    parts = []
    for name, df in links.items():
        ends = dict(zip(SIDES, subgraphs[name]))
        parts.append(df.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("link"), F.lit(side).alias("side"),
                     F.lit(ends[side]).alias("node"), F.col(side).alias("id")) for side in sides])
        ).alias("e")).select("e.*"))
    return reduce(DataFrame.unionByName, parts)


def check_graph(nodes: dict[str, DataFrame], links: dict[str, DataFrame],
                subgraphs: dict[str, tuple[str, str]], sides: Sequence[str] = SIDES) -> DataFrame:
    """One row per (link, side): n_links, n_nodes (rows of the node table),
    n_ids (distinct ids at that end), n_orphans (of those, not a node id).
    ``sides`` limits the check; the other end is then not read."""
    spark = next(iter(links.values())).sparkSession
    wanted = [(l, side, subgraphs[l][SIDES.index(side)]) for l in links for side in sides]
    checks = spark.createDataFrame(wanted, CHECK_SCHEMA)
    used = {w[2] for w in wanted}

    ends = (_ends(links, subgraphs, sides).groupBy("link", "side", "node", "id")
            .agg(F.count(F.lit(1)).alias("n")))
    ids = (reduce(DataFrame.unionByName, [
        df.select(F.lit(n).alias("node"), F.col("node_id").alias("id"))
        for n, df in nodes.items() if n in used])
        .groupBy("node", "id").agg(F.count(F.lit(1)).alias("n")))

    marked = ends.alias("e").join(
        ids.select("node", "id", F.lit(True).alias("found")).alias("n"),
        (F.col("e.node") == F.col("n.node")) & F.col("e.id").eqNullSafe(F.col("n.id")), "left")
    per_end = marked.groupBy("e.link", "e.side").agg(
        F.sum("e.n").alias("n_links"), F.count(F.lit(1)).alias("n_ids"),
        F.count(F.when(F.col("found").isNull(), F.lit(1))).alias("n_orphans"))
    per_node = ids.groupBy("node").agg(F.sum("n").alias("n_nodes"))

    out = checks.join(per_end, ["link", "side"], "left").join(per_node, "node", "left")
    return out.select(
        "link", "side", "node",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
          for c in ("n_links", "n_nodes", "n_ids", "n_orphans")],
        (F.coalesce(F.col("n_orphans"), F.lit(0)) == 0).alias("ok"))


def assert_valid(check: DataFrame) -> None:
    """Raise if any link end is missing from its node table (26 rows collected)."""
    bad = check.where(~F.col("ok")).select("link", "side", "node", "n_orphans").collect()
    if bad:
        lines = ", ".join(f"{r.link}.{r.side}->{r.node}: {r.n_orphans}" for r in bad)
        raise AssertionError(f"link ids not in node tables: {lines}")
