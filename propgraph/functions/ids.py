"""Stable text ids for natural keys.

A node or link id is the md5 of its natural key as text. A composite key is
joined with ``|`` after turning each NULL part into ``''``, so ``(NULL, 'x')``
and ``('', 'x')`` share one id on purpose: graph consumers see one vertex for
the two spellings. A single NULL key gets the id ``'null'`` so that ids are
never NULL. md5 is 128 bits, so collisions are negligible at any realistic
node count, and DuckDB's md5 gives the same text (used by the oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(*cols: ColumnOrName) -> Column:
    """Natural key as text: one column as is, several joined with ``|``."""
    if len(cols) == 1:
        return _col(cols[0]).cast("string")
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws("|", *parts)


def key_id(*cols: ColumnOrName) -> Column:
    """Id of a natural key; never NULL."""
    return F.coalesce(F.md5(key_text(*cols)), F.lit("null"))


def to_int(c: ColumnOrName) -> Column:
    """A count as INT the way SQL engines cast a double: round half to even,
    NULL when it does not fit (``3.0`` -> 3, ``2.5`` -> 2)."""
    return F.bround(_col(c)).try_cast("int")
