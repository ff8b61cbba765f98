"""Numeric helpers: exact integers, then one float step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scale_down(raw, decimals) -> Column:
    """``float(raw) / 10 ** decimals``: the integer is cast to double first
    (two roundings, like the reference's float(balance) / 10**d)."""
    return _c(raw).cast("double") / F.pow(F.lit(10), _c(decimals))


def scale_down_exact(raw, decimals) -> Column:
    """``int / 10 ** d`` rounded once: parse the decimal literal 'n e-d'.
    Works for any DECIMAL(38,0) magnitude; null in, null out."""
    return F.concat(_c(raw).cast("decimal(38,0)").cast("string"), F.lit("e-"),
                    _c(decimals).cast("string")).cast("double")


def ratio(num, den) -> Column:
    """num / den as doubles; null when den is 0 (SQL NULLIF)."""
    d = _c(den).cast("double")
    return _c(num).cast("double") / F.when(d != 0, d)


def lookup(key: Column, table: dict, default=None) -> Column:
    """The value of a small constant table by key, else ``default`` (null)."""
    expr = F.when(F.lit(False), F.lit(None))
    for k, v in table.items():
        expr = expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def valid_decimals(value) -> Column:
    """A token's decimals as an integer: an unsigned byte on chain, so anything
    outside 0..255 (or not a number) counts as unresolved (null)."""
    d = _c(value).try_cast("bigint")
    return F.when(d.between(0, 255), d).cast("int")
