"""Node and link tables from canonical tables: filter, DISTINCT ON the natural
key, then ids. The id is computed after the dedup from the key columns, so
the aggregate carries only the key and the attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import key_id
from ..plans.spec import LinkSpec, NodeSpec, attr_column
from .distinct import distinct_on


def extract_node(src: DataFrame, spec: NodeSpec) -> DataFrame:
    """``node_id`` plus attributes, one row per distinct natural key."""
    df = src.where(spec.where()) if spec.where is not None else src
    kcols = [f"_k{i}" for i in range(len(spec.keys))]
    if all(isinstance(a[1], str) and a[1] in spec.keys for a in spec.attrs):
        # Attributes are key columns: the kept row is fixed by the key, so a
        # plain distinct (hash aggregate) does it.
        pos = dict(zip(spec.keys, kcols))
        keys = df.select(*[F.col(k).alias(kc) for k, kc in zip(spec.keys, kcols)]).distinct()
        return keys.select(key_id(*kcols).alias("node_id"),
                           *[F.col(pos[a[1]]).alias(a[0]) for a in spec.attrs])
    df = df.select(*[F.col(k).alias(kc) for k, kc in zip(spec.keys, kcols)],
                   *[attr_column(a) for a in spec.attrs])
    # attributes the key fixes need no picked row: a distinct is a hash aggregate
    df = df.distinct() if spec.determined else distinct_on(df, kcols)
    return df.select(key_id(*kcols).alias("node_id"), *[a[0] for a in spec.attrs])


def extract_link(src: DataFrame, spec: LinkSpec) -> DataFrame:
    """``link_id, from_id, to_id`` plus attributes, one row per distinct key.

    Endpoint key columns outside the distinct key ride along with the picked
    row (none do in the registry graph).
    """
    df = src.where(spec.where()) if spec.where is not None else src
    names = {k: f"_k{i}" for i, k in enumerate(spec.keys)}
    extra = [k for k in dict.fromkeys(spec.src_key + spec.dst_key) if k not in names]
    names.update({k: f"_x{i}" for i, k in enumerate(extra)})
    df = df.select(*[F.col(k).alias(names[k]) for k in spec.keys],
                   *[attr_column(a) for a in spec.attrs],
                   *[F.col(k).alias(names[k]) for k in extra])
    df = distinct_on(df, [names[k] for k in spec.keys])
    return df.select(key_id(*[names[k] for k in spec.keys]).alias("link_id"),
                     key_id(*[names[k] for k in spec.src_key]).alias("from_id"),
                     key_id(*[names[k] for k in spec.dst_key]).alias("to_id"),
                     *[a[0] for a in spec.attrs])
