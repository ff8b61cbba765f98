"""Native decoding of length-prefixed strings inside a BINARY blob."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import lenient_decode, strip_ws


def u32_le(blob: Column, offset0: int) -> Column:
    """Little-endian unsigned 32-bit integer at a 0-based byte offset."""
    h = F.hex(F.substring(blob, offset0 + 1, 4))
    swapped = F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2),
                       F.substring(h, 3, 2), F.substring(h, 1, 2))
    return F.conv(swapped, 16, 10).cast("bigint")


def lenient_utf8(raw: Column) -> Column:
    """decode('utf-8', errors='ignore'), drop trailing NULs, strip; '' -> null."""
    s = strip_ws(F.rtrim(lenient_decode(raw), F.lit("\u0000")))
    return F.when(s != F.lit(""), s)


def read_length_prefixed(blob: Column, offset0: int) -> Column:
    """String stored as u32 length + bytes at ``offset0``.  Null when the
    prefix or the body runs past the end, or the length is 0.  The length is
    not capped at the field width."""
    size = F.length(blob)
    n = u32_le(blob, offset0)
    body = F.substring(blob, offset0 + 5, F.least(n, F.lit(2147483647)).cast("int"))
    ok = (F.lit(offset0 + 4) <= size) & (n != 0) & (F.lit(offset0 + 4) + n <= size)
    return F.when(ok, lenient_utf8(body))
