"""Connected components by contracting labels.

Every round each vertex moves to its smallest neighbour, if that is smaller than
itself, and on to where that one went, until it stands at a vertex that stays
(moves are doubled: a chain of n moves is followed in log n steps). The edges
are contracted to where their ends went; the rest is a smaller graph of the same
components. Every vertex that stays was joined by a neighbour at least, so a
round leaves at most half the vertices. A star around its smallest member (what
``star_edges`` makes) is gone after one round.

Edges and labels are cut with reliable checkpoints each round: a lost executor
never recomputes earlier rounds. Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from . import skew
from .skew import spread_join


def star_edges(members: DataFrame, key: str = "key", node: str = "node_id") -> DataFrame:
    """(u, v): every member of a key linked to the key's smallest member. The
    same components as all pairs of a key, in as many edges as members."""
    rows = reliable_checkpoint(members.select(F.col(node).alias("u"), F.col(key).alias("_key")))
    first = rows.groupBy("_key").agg(F.min("u").alias("v"))
    return spread_join(rows, first, "_key").select("u", "v").where("u <> v").distinct()


#: Doublings of the moves before they are written and looked at.
JUMPS = 2


def _plain(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return rows.join(table, key)


def _spread(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return spread_join(reliable_checkpoint(rows), table, key)


def _followed(moves: DataFrame, meet) -> DataFrame:
    """(u, to, far) after ``JUMPS`` doublings; ``far``: the last one still led on."""
    for _ in range(JUMPS):
        onward = moves.select(F.col("u").alias("to"), F.col("to").alias("next"))
        step = meet(moves.select("u", "to"), onward, "to")
        moves = step.select("u", F.col("next").alias("to"), (F.col("to") != F.col("next")).alias("far"))
    return moves


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every vertex of ``edges`` (u, v); ``component`` is the
    smallest vertex reachable."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    rest = reliable_checkpoint(both.where("u <> v").distinct())
    labels = reliable_checkpoint(both.select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node")))
    while (left := rest.count()) > 0:
        # of few rows no key is hot: plain joins, and nothing to write between them
        meet = _plain if left <= skew.HOT_FLOOR else _spread
        moves = rest.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to"))
        moves = reliable_checkpoint(_followed(moves, meet))
        while not moves.where("far").isEmpty():
            moves = reliable_checkpoint(_followed(moves.select("u", "to"), meet))
        there = moves.select(F.col("u").alias("v"), F.col("to").alias("b"))
        half = meet(rest, moves.select("u", "to"), "u").select(F.col("to").alias("a"), "v")
        rest = reliable_checkpoint(meet(half, there, "v").where("a <> b")
                                   .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        moved = moves.where("u <> to").select(F.col("u").alias("label"), "to")
        labels = reliable_checkpoint(spread_join(labels, moved, "label", "left")
                                     .select("node", F.coalesce("to", "label").alias("label")))
    first = labels.groupBy("label").agg(F.min("node").alias("component"))
    return spread_join(labels, first, "label").select("node", "component")
