"""Swap-source helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BONDING_MARKER, SOURCE_PREFIXES


def canonical_source(col: Column | str = "source") -> Column:
    """Strip the aggregator prefixes.  LIKE semantics on purpose: '_' matches
    any one character, so 'jupiter6Xfoo' -> 'foo' and 'jupiter6_' -> ''."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for pattern, start in SOURCE_PREFIXES:
        cond = c.like(pattern)
        branch = F.substring(c, start, 2147483647)
        expr = F.when(cond, branch) if expr is None else expr.when(cond, branch)
    return expr.otherwise(c)


def is_bonding(col: Column | str = "source") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c).contains(BONDING_MARKER)


def pool_class(col: Column | str = "source") -> Column:
    return F.when(is_bonding(col), F.lit("bonding")).otherwise(F.lit("priority"))
