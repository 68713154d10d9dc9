"""``DISTINCT ON``: one whole row per key.

Spark SQL has no ``DISTINCT ON``. The row kept per key is made deterministic:
the one with the smallest ``order`` tuple, NULLs first (the default order is
the remaining columns in table order). It is an aggregate, so Spark combines
map-side first: a hot key costs one row per map partition in the shuffle,
never a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: Sequence[str],
                order: Sequence[str] | None = None) -> DataFrame:
    """One whole row per ``keys`` value: the row with the smallest ``order`` tuple
    (NULLs first; default: the other columns in table order)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = [c for c in (order or rest) if c in rest]
    payload = order + [c for c in rest if c not in order]
    picked = (df.groupBy(*keys)
                .agg(F.min(F.struct(*[F.col(c) for c in payload])).alias("_row")))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                           for c in df.columns])
