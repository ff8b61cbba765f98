"""Key normalisation (decode ignoring bad UTF-8, drop NULs, strip)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType

# Whitespace exactly as Python's str.strip() sees it, built from the rule.
WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())
_NUL = "\u0000"
_REPLACEMENT = "�"


# A noncharacter that marks replacement characters which are really in the text.
_MARK = "\uFDD0"


def lenient_decode(col: Column) -> Column:
    """BINARY -> STRING dropping invalid UTF-8 sequences (decode 'ignore').

    ``make_valid_utf8`` turns invalid bytes into U+FFFD, which are then dropped;
    a U+FFFD of the text itself is escaped before and restored after.  Valid
    bytes, nearly all of a feed, pass as they are."""
    text = col.cast("string")
    s = F.replace(text, F.lit(_MARK), F.lit(_MARK + "0"))
    s = F.replace(s, F.lit(_REPLACEMENT), F.lit(_MARK + "1"))
    s = F.replace(F.make_valid_utf8(s), F.lit(_REPLACEMENT), F.lit(""))
    s = F.replace(s, F.lit(_MARK + "1"), F.lit(_REPLACEMENT))
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(s, F.lit(_MARK + "0"), F.lit(_MARK)))


def strip_ws(col: Column) -> Column:
    """str.strip(): remove the whitespace set from both ends (no regex)."""
    return F.trim(col, F.lit(WHITESPACE))


def normalize_key(col: Column | str, dtype: DataType | None = None) -> Column:
    """Normalise a token key: lenient UTF-8 decode (binary input), remove every
    NUL, strip surrounding whitespace.  Idempotent; null stays null.

    The key is referenced once: Catalyst copies a pushed-down filter's
    expression into the scan, so a many-reference form would evaluate an
    expensive key expression many times per row."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, BinaryType):
        c = lenient_decode(c)
    return strip_ws(F.replace(c, F.lit(_NUL), F.lit("")))


def is_valid_key(col: Column | str) -> Column:
    """``mint IS NOT NULL AND mint != ''``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))
