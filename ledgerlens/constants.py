"""Fixed values that must equal the reference's for right results.

FIXED VALUES (addresses, preset decimals, default prices), in natural order:

    SOL   So11111111111111111111111111111111111111112   decimals 9
    USDC  EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v  decimals 6
    USDT  Es9vMFrzaCERmJfrF4H2FYD4KCoNkY11McCe8BenwNYB  decimals 6
    USDH  USDH1SM1ojwWUga67PGrgFWUHibbjqMvuMaDkRJTgkX   decimals 6 (static supply table only)
    SOL price in USD: 190.0
    Default decimals: 6 for resolved lookups, 9 for the static supply table,
                      9 for SOL and 6 otherwise inside pools.
    Blockchain label: 'solana'
    Source prefixes stripped from swap sources: 'jupiter6_' and 'jupiter4_'
        (keep from character 10), 'raydium_route_' (keep from character 15),
        matched with LIKE so '_' is a one-character wildcard.
    Bonding-curve marker in a lower-cased source: 'bondingcurve'
    Recent swaps considered per token for the trade price: 100
    Account blob: name length prefix at byte 65, symbol at 101, uri at 115
        (0-based), blobs shorter than 65 bytes carry no metadata.
    Account blob JSON path: $.result.value.data[0]
    Decimals JSON path: $.result.value.data.parsed.info.decimals
"""

SOL = "So11111111111111111111111111111111111111112"
USDC = "EPjFWdd5AufqSSqeM2qN1xzybapC8G4wEGGkZwyTDt1v"
USDT = "Es9vMFrzaCERmJfrF4H2FYD4KCoNkY11McCe8BenwNYB"
USDH = "USDH1SM1ojwWUga67PGrgFWUHibbjqMvuMaDkRJTgkX"

STABLECOINS = (USDC, USDT)
ANCHORS = (SOL, USDC, USDT)

# Decimals the resolver knows without asking (never overwritten).
PRESET_DECIMALS = {SOL: 9, USDC: 6, USDT: 6}
# Static table used by the supply calculator when no resolved map is given.
STATIC_DECIMALS = {SOL: 9, USDC: 6, USDT: 6, USDH: 6}

DEFAULT_RESOLVED_DECIMALS = 6
DEFAULT_STATIC_DECIMALS = 9
DEFAULT_POOL_DECIMALS = 6
SOL_POOL_DECIMALS = 9

SOL_PRICE_USD = 190.0
BLOCKCHAIN = "solana"

SOURCE_PREFIXES = (("jupiter6_%", 10), ("jupiter4_%", 10), ("raydium_route_%", 15))
BONDING_MARKER = "bondingcurve"

RECENT_SWAPS_PER_TOKEN = 100

BLOB_MIN_LENGTH = 65
NAME_OFFSET = 65
SYMBOL_OFFSET = NAME_OFFSET + 4 + 32
URI_OFFSET = SYMBOL_OFFSET + 4 + 10

ACCOUNT_JSON_PATH = "$.result.value.data[0]"
DECIMALS_JSON_PATH = "$.result.value.data.parsed.info.decimals"

# Output column order of the per-token record.
TOKEN_METRICS_COLUMNS = (
    "token_address", "blockchain", "symbol", "price_usd", "market_cap_usd",
    "supply", "burned", "largest_lp_pool_usd", "first_tx_date", "source",
    "name", "uri",
)
