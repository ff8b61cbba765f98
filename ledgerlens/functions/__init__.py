"""Column-level helpers: each returns a Spark ``Column`` built from native
expressions, so everything stays inside whole-stage codegen."""

from .keys import normalize_key, is_valid_key
from .numeric import scale_down, scale_down_exact, ratio
from .sources import canonical_source, pool_class, is_bonding
from .binary import u32_le, lenient_utf8, read_length_prefixed

__all__ = [
    "normalize_key", "is_valid_key", "scale_down", "scale_down_exact", "ratio",
    "lookup", "valid_decimals", "canonical_source", "pool_class", "is_bonding", "u32_le",
    "lenient_utf8", "read_length_prefixed",
]
