"""Merge subgraph tables that describe the same kind of node or link.

Semantics: the key population is the distinct keys over all children; each
population key is left-joined with every child; a select list combines the
children's columns (usually ``coalesce`` in child order).

* ``distinct=True`` (one row per key): each child is reduced to one whole row
  per key and the children are merged in ONE aggregate over a tagged union:
  a single shuffle for any number of children, with map-side combine.
* ``distinct=False`` (rows kept with their multiplicity): chained full outer
  joins on the key. For a key present in children S this yields the product
  of the children's row counts over S, exactly what population LEFT JOIN
  child_1 .. LEFT JOIN child_n gives, without building the population.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .distinct import distinct_on

NODE_KEY = ("node_id",)
LINK_KEY = ("from_id", "to_id")


def population(children: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys over all children (one shuffle)."""
    keys = list(keys)
    return reduce(DataFrame.unionByName, [c.select(*keys) for c in children]).distinct()


def _tag(child: DataFrame, i: int, keys: list[str]) -> DataFrame:
    return child.select(*keys, F.struct(*[F.col(c) for c in child.columns]).alias(f"t{i}"))


def merge_children(children: Sequence[DataFrame], keys: Sequence[str],
                   select: Callable[[], list[Column]], distinct: bool = True) -> DataFrame:
    """Keys are ids, never NULL (``key_id``); see the module docstring."""
    keys = list(keys)
    tagged = [_tag(c, i + 1, keys) for i, c in enumerate(children)]
    if distinct:
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
        merged = union.groupBy(*keys).agg(
            *[F.min(f"t{i + 1}").alias(f"t{i + 1}") for i in range(len(children))])
    else:
        merged = reduce(lambda a, b: a.join(b, on=keys, how="full"), tagged)
    return merged.select(*select())


def passthrough(child: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An ungrouped table: one row per key."""
    return distinct_on(child, keys)


def group_nodes(children: Sequence[DataFrame], select: Callable[[], list[Column]] | None,
                distinct: bool = True) -> DataFrame:
    """A final node table: pass-through of one child, or the merge of several
    by ``select`` (one row per node_id when ``distinct``)."""
    if select is None:
        if len(children) != 1:
            raise ValueError("several children need a select list")
        return passthrough(children[0], NODE_KEY)
    return merge_children(children, NODE_KEY, select, distinct)


def group_links(children: Sequence[DataFrame], select: Callable[[], list[Column]] | None,
                distinct: bool = False) -> DataFrame:
    """A final link table: pass-through of one child, or the merge of several
    by ``select`` (left-join multiplicity kept unless ``distinct``)."""
    if select is None:
        if len(children) != 1:
            raise ValueError("several children need a select list")
        return passthrough(children[0], LINK_KEY)
    return merge_children(children, LINK_KEY, select, distinct)
