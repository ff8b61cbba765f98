"""Enrichment lookups re-aimed as jobs over captured tables.

The reference asks a JSON-RPC node for each token's decimals and metadata
account.  Here the captured replies are an input table; parsing is a
projection over it, so it runs on executors and scales with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (ACCOUNT_JSON_PATH, DECIMALS_JSON_PATH, DEFAULT_RESOLVED_DECIMALS, NAME_OFFSET,
                         PRESET_DECIMALS, SYMBOL_OFFSET, URI_OFFSET, BLOB_MIN_LENGTH)
from ..functions.binary import read_length_prefixed
from ..functions.numeric import lookup, valid_decimals

_B64 = "[A-Za-z0-9+/]"
_REPLY = "id bigint, result string"


def replies_by_request(requests: DataFrame, batches: DataFrame) -> DataFrame:
    """Requests (batch, id, mint) and bodies (batch, body) -> (mint, batch, place, result).

    A body is the JSON array of a batch's replies in any order, or a single reply, which
    counts as an array of one.  A reply belongs to the request of its batch and id; one
    whose id is missing, no number or was not asked for is dropped.  Every request keeps at
    least one row: without a reply, or where the body is null, broken or absent, its
    place and result are null.  ``place`` is the reply's position in its array, ``result``
    its JSON text.  Each element is parsed by itself, so an odd one costs no other, and the
    join key (batch, id) is as fine as the requests."""
    bodies = F.coalesce(F.from_json("body", "array<string>"), F.array("body"))
    replies = (batches.select("batch", F.posexplode(bodies).alias("place", "_text"))
               .select("batch", "place", F.from_json("_text", _REPLY).alias("_r"))
               .select("batch", "place", "_r.id", "_r.result").where(F.col("id").isNotNull()))
    return requests.select("mint", "batch", "id").join(replies, ["batch", "id"], "left").select("mint", "batch", "place", "result")


def decimals_from_batches(requests: DataFrame, batches: DataFrame) -> DataFrame:
    """(mint, decimals) for every mint asked for in a batch.

    Presets win; then the last parsed value (by batch and place: later replies replace
    earlier ones, a failed one replaces nothing); else 6."""
    value = valid_decimals(F.get_json_object("result", DECIMALS_JSON_PATH.replace("$.result", "$")))
    last = F.max(F.when(F.col("_v").isNotNull(), F.struct("batch", "place", "_v")))
    per_key = (replies_by_request(requests, batches).select("mint", "batch", "place", value.alias("_v"))
               .groupBy("mint").agg(last.alias("_s")))
    return per_key.select(
        "mint", F.coalesce(lookup(F.col("mint"), PRESET_DECIMALS), F.col("_s._v"),
                           F.lit(DEFAULT_RESOLVED_DECIMALS)).cast("bigint").alias("decimals"))


def metadata_from_batches(requests: DataFrame, batches: DataFrame) -> DataFrame:
    """(mint, symbol, name, uri) for every mint asked for in a batch; three nulls without a
    readable account.  Replies are matched by id, so their order does not matter."""
    blob = F.get_json_object("result", ACCOUNT_JSON_PATH.replace("$.result", "$"))
    accounts = replies_by_request(requests, batches).select("mint", blob.alias("account_data_b64"))
    return metadata_per_token(account_metadata(accounts))


def decimals_from_responses(responses: DataFrame) -> DataFrame:
    """(mint, response_json) -> (mint, decimals).

    Presets (SOL 9, USDC 6, USDT 6) win; then the parsed
    ``result.value.data.parsed.info.decimals``; a missing account, an
    unparsed payload, malformed JSON, an error reply or a value outside
    0..255 give 6."""
    parsed = F.get_json_object(F.col("response_json"), DECIMALS_JSON_PATH)
    value = valid_decimals("_parsed")
    # several replies for one mint: a parsed value wins over a failed one
    per_key = (responses.select("mint", parsed.alias("_parsed"))
               .select("mint", value.alias("_v"))
               .groupBy("mint").agg(F.max("_v").alias("_v")))
    return per_key.select(
        "mint", F.coalesce(lookup(F.col("mint"), PRESET_DECIMALS), F.col("_v"),
                           F.lit(DEFAULT_RESOLVED_DECIMALS)).cast("bigint").alias("decimals"))


def metadata_per_token(metadata: DataFrame) -> DataFrame:
    """One (symbol, name, uri) per mint; when a mint repeats, the row with a
    symbol (then the greatest) wins, deterministically."""
    best = F.max(F.struct(F.col("symbol").isNotNull().alias("has_symbol"), "symbol", "name", "uri"))
    return (metadata.groupBy("mint").agg(best.alias("_m"))
            .select("mint", "_m.symbol", "_m.name", "_m.uri"))


def account_metadata(accounts: DataFrame) -> DataFrame:
    """(mint, account_data_b64 and/or response_json) -> (mint, symbol, name, uri), all native.

    The blob is given as base64, or as the whole reply, whose
    ``result.value.data[0]`` is then taken.  Characters outside the alphabet are
    skipped and what follows a complete padding is ignored; a missing or
    misplaced padding is bad base64.  Bad base64 or a blob shorter than 65 bytes gives three nulls; each string
    is a u32-LE length plus UTF-8 bytes at a fixed offset (name 65, symbol
    101, uri 115), decoded leniently, trailing NULs and whitespace removed,
    '' -> null."""
    given = [F.col("account_data_b64")] if "account_data_b64" in accounts.columns else []
    if "response_json" in accounts.columns:
        given.append(F.get_json_object("response_json", ACCOUNT_JSON_PATH))
    clean = F.regexp_replace(F.coalesce(*given), "[^A-Za-z0-9+/=]", "")
    quads = F.regexp_extract(clean, f"^((?:{_B64}{{4}})*(?:{_B64}{{2}}==|{_B64}{{3}}=)?)", 1)
    whole = (F.length(quads) == F.length(clean)) | quads.endswith("=")
    blob = F.try_to_binary(F.when(whole, quads), F.lit("base64"))
    b = F.col("_blob")
    ok = b.isNotNull() & (F.length(b) >= BLOB_MIN_LENGTH)

    def field(offset: int) -> Column:
        return F.when(ok, read_length_prefixed(b, offset))

    return (accounts
            .select("mint", blob.alias("_blob"))
            .select("mint",
                    field(SYMBOL_OFFSET).alias("symbol"),
                    field(NAME_OFFSET).alias("name"),
                    field(URI_OFFSET).alias("uri")))
