"""Parameterised SQL over the run's relations.

A statement names relations as ``{mints}`` and values as ``:token``.  Values are bound,
never written into the statement, so a token key may hold any character; relations are
DataFrames, so no identifier comes from outside either.  Filters on a bound value are
filters on a literal for Catalyst and reach the Parquet reader.
"""

from __future__ import annotations

import string
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import TokenTables


def bound_query(spark: SparkSession, statement: str, parameters: Mapping[str, Any] | None = None,
                tables: TokenTables | Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows of ``statement`` as a lazy frame.

    ``parameters`` gives a value for each ``:name`` (strings, numbers, decimals, times,
    booleans, None; a list becomes an array, for ``array_contains(:tokens, mint)``);
    ``tables`` the relation for each ``{name}``.  A missing value, a relation that is
    not there or is no DataFrame, and a placeholder with a conversion or an attribute
    raise ValueError, so nothing but whole relations can stand in a placeholder."""
    if tables is None:
        given: dict[str, Any] = {}
    elif isinstance(tables, TokenTables):
        given = dict(vars(tables))
    else:
        given = dict(tables)
    used = {}
    for _, name, spec, conversion in string.Formatter().parse(statement):
        if name is None:
            continue
        if not name.isidentifier() or spec or conversion:
            raise ValueError(f"not the name of a relation: {{{name}}}")
        if not isinstance(given.get(name), DataFrame):
            raise ValueError(f"no relation {name}")
        used[name] = given[name]
    values = {k: as_argument(v) for k, v in (parameters or {}).items()}
    return spark.sql(statement, args=values, **used)


def as_argument(value: Any) -> Any:
    """Lists and tuples as array columns of literals (an empty one holds a null, which equals nothing); anything else as it is."""
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value or (None,)])
    return value
