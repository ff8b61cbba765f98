"""Token discovery (A1, P1, O1) and runs over a bounded set of tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import is_valid_key
from ..sources.tables import TokenTables

#: So many keys are written into the scans' filters; larger sets are joined to the aggregates.
MAX_PUSHED_TOKENS = 10_000


def discover_tokens(mints: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct non-null, non-empty ``mint`` keys.  ``limit`` keeps the first
    ``n`` in key order (TakeOrderedAndProject); default: every token."""
    tokens = mints.select("mint").where(is_valid_key("mint")).distinct()
    if limit is not None:
        tokens = tokens.orderBy("mint").limit(int(limit))
    return tokens


def first_tokens(mints: DataFrame, n: int) -> list[str]:
    """The first ``n`` keys in key order, on the driver: at most ``MAX_PUSHED_TOKENS``."""
    if not 0 <= n <= MAX_PUSHED_TOKENS:
        raise ValueError(f"between 0 and {MAX_PUSHED_TOKENS} tokens, not {n}")
    return [r.mint for r in discover_tokens(mints, n).collect()]


def only_tokens(tables: TokenTables, tokens: Sequence[str]) -> TokenTables:
    """The tables cut to what a run over ``tokens`` can use: mints, burns and lookups of
    these keys, swaps with one of them on a side (a candidate pool has one).

    The keys are literals of an ``IN`` filter, so rows of other tokens leave at the scan -
    on cleaned tables in the Parquet reader - before any aggregate or shuffle; a semi join
    would have to move a hot key's events to its task first.  The results of the operators
    over these tables are those of the same token set over the whole ones."""
    keys = list(dict.fromkeys(tokens))
    if len(keys) > MAX_PUSHED_TOKENS:
        raise ValueError(f"at most {MAX_PUSHED_TOKENS} tokens, not {len(keys)}")

    def of(name: str):
        return F.col(name).isin(keys)

    lookups = {name: df.where(of("mint")) for name, df in vars(tables).items()
               if df is not None and "mint" in df.columns and name not in ("mints", "burns")}
    return tables.with_(mints=tables.mints.where(of("mint")), burns=tables.burns.where(of("mint")),
                        swaps=tables.swaps.where(of("base_coin") | of("quote_coin")), **lookups)
