"""Row filters shared by the extraction specs. All return non-NULL booleans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import ColumnOrName, _col


def is_blank(c: ColumnOrName) -> Column:
    """NULL or ''."""
    c = _col(c)
    return c.isNull() | (c == "")


def not_blank(c: ColumnOrName, *excluded: str) -> Column:
    """Not NULL, not '' and none of ``excluded`` (e.g. the 'UNKNOWN' marker)."""
    c = _col(c)
    cond = c.isNotNull() & (c != "")
    if excluded:
        cond = cond & ~c.isin(*excluded)
    return cond


def not_both_blank(a: ColumnOrName, b: ColumnOrName) -> Column:
    """At least one of the two is neither NULL nor ''; never NULL itself."""
    return ~(is_blank(a) & is_blank(b))


def equals(c: ColumnOrName, value: str) -> Column:
    """NULL-safe equality with a literal."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))
