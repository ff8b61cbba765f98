"""Token event relations derived from the driver's TPC-H-style tables.

The driver's data has no token events, so ``mints``, ``burns``, ``swaps``,
``token_decimals``, ``decimals_responses`` and ``metadata_accounts`` are
derived from ``lineitem`` and ``part`` by the SQL below (the rules in
FIXTURES.md).  The same text runs in Spark SQL and in DuckDB: Spark gets the
base tables as DataFrame arguments of ``spark.sql``; the DuckDB oracle gets the
texts as CTEs over its pre-registered views.  Templates use ``{lineitem}`` /
``{part}`` placeholders and ``{{ }}`` for literal braces.

The modulo rules below are part of the derivation (they create tokens without
swaps, null times and missing decimals).  Every ``lineitem`` row feeds at least
one relation: the mints take the return flag 'N', the burns 'R' and 'A', the
swaps the line status 'O' except for the swapless tokens; ``part`` feeds the lookups.
"""

from __future__ import annotations

import re

from ..constants import SOL, USDC, USDH, USDT


def token_expr(k: str) -> str:
    """TOKEN(k): keys 1..3 are the anchors, 4 is USDH, others 'T' + 8-digit id."""
    return (f"case {k} when 1 then '{SOL}' when 2 then '{USDC}' when 3 then '{USDT}' "
            f"when 4 then '{USDH}' else concat('T', lpad(cast({k} as string), 8, '0')) end")


MINTS_SQL = f"""
select case when l_linenumber = 7 and l_suppkey % 10 = 0 then ''
            when l_linenumber = 7 and l_suppkey % 10 = 1 then null
            else {token_expr('l_partkey')} end as mint,
       cast(l_quantity * 100000000 as decimal(20,0)) as amount,
       case when l_partkey % 41 = 0 then null else l_shipdate end as block_time
from {{lineitem}} where l_returnflag = 'N'
"""

BURNS_SQL = f"""
select {token_expr('l_partkey')} as mint,
       cast(l_quantity * 100000000 as decimal(20,0)) as amount,
       l_shipdate as block_time
from {{lineitem}} where l_returnflag in ('R', 'A')
"""

SWAPS_SQL = f"""
select source,
       case when tok_is_base then tok else ctr end as base_coin,
       case when tok_is_base then ctr else tok end as quote_coin,
       case when tok_is_base then tok_amt else ctr_amt end as base_coin_amount,
       case when tok_is_base then ctr_amt else tok_amt end as quote_coin_amount,
       case when tok_is_base then tok_bal else ctr_bal end as base_pool_balance_after,
       case when tok_is_base then ctr_bal else tok_bal end as quote_pool_balance_after,
       block_time
from (
  select case when l_partkey % 10 = 0 then 'pumpfun_BondingCurve'
              when l_linenumber = 1 then 'jupiter6_raydium_amm'
              when l_linenumber = 2 then 'jupiter4_orca_whirlpool'
              when l_linenumber = 3 then 'raydium_route_raydium_amm'
              when l_linenumber = 4 then 'raydium_amm'
              when l_linenumber = 5 then 'pumpfun_BondingCurve'
              when l_linenumber = 6 then 'jupiter6Xorca_whirlpool'
              else 'orca_whirlpool' end as source,
         {token_expr('l_partkey')} as tok,
         case l_suppkey % 5 when 2 then '{USDC}' when 3 then '{USDT}'
                            when 4 then {token_expr('(l_suppkey + 10)')} else '{SOL}' end as ctr,
         l_orderkey % 2 = 0 as tok_is_base,
         cast(case when l_quantity = 1 then 0 else l_quantity * 1000000 end as decimal(20,0)) as tok_amt,
         cast(round(l_extendedprice * 100) * 10 as decimal(20,0)) as ctr_amt,
         cast(case when l_discount = 0 then 0 else l_quantity * 10000000 end as decimal(20,0)) as tok_bal,
         cast(round(l_extendedprice * 100) * 1000000 as decimal(20,0)) as ctr_bal,
         l_shipdate as block_time
  from {{lineitem}} where l_linestatus = 'O' and l_partkey % 41 <> 0) s
"""

TOKEN_DECIMALS_SQL = f"""
select {token_expr('p_partkey')} as mint,
       case p_partkey when 1 then 9 when 2 then 6 when 3 then 6
            else case p_size % 3 when 0 then 6 when 1 then 9 else 0 end end as decimals
from {{part}} where p_partkey % 7 <> 0 or p_partkey <= 3
"""

# k: 0 no account, 1 unparsed payload, 2 not JSON, 3 and 4 parsed; a value of 1000 is out of range.
DECIMALS_RESPONSES_SQL = f"select {token_expr('p_partkey')} as mint," + """
       case p_partkey % 5
         when 0 then '{{"jsonrpc":"2.0","id":1,"result":{{"value":null}}}}'
         when 1 then '{{"jsonrpc":"2.0","id":1,"result":{{"value":{{"data":["AA==","base64"]}}}}}}'
         when 2 then 'not json'
         else concat('{{"jsonrpc":"2.0","id":1,"result":{{"value":{{"data":{{"parsed":{{"info":{{"decimals":',
                     cast(case when p_partkey % 13 = 0 then 99999999999 else p_size % 10 end as string),
                     '}}}}}}}}}}}}') end as response_json
from {part}
"""

# Expected decimals for DECIMALS_RESPONSES_SQL, independent of any JSON parser.
EXPECTED_DECIMALS_SQL = f"""
select {token_expr('p_partkey')} as mint,
       cast(case when p_partkey = 1 then 9 when p_partkey <= 3 or p_partkey % 5 <= 2 or p_partkey % 13 = 0 then 6
                 else p_size % 10 end as bigint) as decimals
from {{part}}
"""

# Spark only (DuckDB lacks the binary builders used here).
# k: 0 missing, 1 bad base64, 2 too short, 3 empty symbol,
#    4 name length past the end, 5 bad UTF-8 byte, 6 a real U+FFFD in the name,
#    7 stray characters in the base64, 8 the blob inside a whole reply.
_BLOBS_SQL = "select p_partkey, " + token_expr('p_partkey') + """ as mint, k,
  case when k = 0 then null when k = 1 then '!!!' when k = 2 then base64(unhex(repeat('00', 40)))
  else base64(unhex(concat(repeat('00', 65),
    case when k = 4 then 'FFFFFFFF' else concat(lpad(hex(32), 2, '0'), '000000') end,
    rpad(concat(case when k = 5 then 'FF' when k = 6 then 'EFBFBD' else '' end, hex(encode(p_name, 'UTF-8'))), 64, '0'),
    case when k = 3 then '00000000' else '0A000000' end,
    rpad(hex(encode(substring(p_brand, 1, 10), 'UTF-8')), 20, '0'),
    'C8000000',
    rpad(hex(encode(concat('https://m.example/', cast(p_partkey as string)), 'UTF-8')), 400, '0')))) end as blob
from (select *, p_partkey % 11 as k from {part}) s"""

METADATA_ACCOUNTS_SQL = """
select mint, case when k = 8 then null when k = 7 then concat('-', substring(blob, 1, 9), ' ', substring(blob, 10)) else blob end
    as account_data_b64,
  case when k = 8 then concat('{{"jsonrpc":"2.0","id":1,"result":{{"value":{{"data":["', blob, '","base64"]}}}}}}') end
    as response_json
from (""" + _BLOBS_SQL + """) b
"""

# Expected decode of METADATA_ACCOUNTS_SQL (the DuckDB oracle's metadata).
EXPECTED_METADATA_SQL = f"""
select {token_expr('p_partkey')} as mint,
  case when k <= 3 then null else substring(p_brand, 1, 10) end as symbol,
  case when k in (0, 1, 2, 4) then null when k = 6 then concat('\uFFFD', p_name) else p_name end as name,
  case when k <= 2 then null else concat('https://m.example/', cast(p_partkey as string)) end as uri
from (select *, p_partkey % 11 as k from {{part}}) s
"""

# Batch requests: (batch, id, mint); ids count from 1 in each batch of 25 (decimals) or 20 (metadata).
def requests_sql(size: int) -> str:
    return f"""
select cast(floor((p_partkey - 1) / {size}) as bigint) as batch, cast((p_partkey - 1) % {size} + 1 as bigint) as id,
       {token_expr('p_partkey')} as mint
from {{part}}
"""


def _array_of_replies(select: str) -> str:
    """Bodies (batch, arr): the replies of a batch as one JSON array, in an order that is not that of the ids."""
    return f"""(select batch, concat('[', array_join(transform(sort_array(collect_list(struct(place, reply))), x -> x.reply), ','), ']') as arr
  from ({select}) r where reply is not null group by batch)"""


_DECIMALS_REPLY = """concat('{{"jsonrpc":"2.0","id":', i, ',"result":{{"value":{{"data":{{"parsed":{{"info":{{"decimals":', d, '}}}}}}}}}}}}')"""


def _reply(i: str, d: str) -> str:
    return re.sub(r", i, ", f", {i}, ", _DECIMALS_REPLY, count=1).replace(", d, ", f", {d}, ")


# Spark only.  Replies, k = p_partkey % 11: 0 none, 1 no account, 2 unparsed payload, 3 an error, 4 an id nobody asked for,
# 5 the id as a string, 6 two parsed replies, 7 a parsed one and then none, 8 out of range, else parsed.
# Bodies, batch % 9: 0 null, 1 not JSON, 2 cut off, 3 one reply and no array, 4 no row, 5 an empty array, else the array.
DECIMALS_BATCHES_SQL = f"""
select batch, case batch % 9 when 0 then null when 1 then 'not json' when 2 then substring(arr, 1, length(arr) - 9)
                             when 3 then {_reply("'1'", "'3'")} when 5 then '[]' else arr end as body
from """ + _array_of_replies(f"""
  select batch, xxhash64(i, batch) as place, case k when 0 then null
      when 1 then concat('{{{{"id":', i, ',"result":{{{{"value":null}}}}}}}}')
      when 2 then concat('{{{{"id":', i, ',"result":{{{{"value":{{{{"data":["AA==","base64"]}}}}}}}}}}}}')
      when 3 then concat('{{{{"id":', i, ',"error":{{{{"code":-32005}}}}}}}}')
      when 4 then {_reply("concat('1000', i)", "d")}
      when 5 then {_reply("concat('\"', i, '\"')", "d")}
      when 6 then concat({_reply("i", "d")}, ',', {_reply("i", "cast((p_size + 1) % 10 as string)")})
      when 7 then concat({_reply("i", "d")}, ',', '{{{{"id":', i, ',"result":{{{{"value":null}}}}}}}}')
      when 8 then {_reply("i", "'300'")} else {_reply("i", "d")} end as reply
  from (select *, floor((p_partkey - 1) / 25) as batch, cast((p_partkey - 1) % 25 + 1 as string) as i,
               cast(p_size % 10 as string) as d, p_partkey % 11 as k from {{part}}) s""") + """ b
where batch % 9 <> 4
"""

# Expected decimals of the batches, independent of any JSON parser.
EXPECTED_BATCH_DECIMALS_SQL = f"""
select {token_expr('p_partkey')} as mint,
       cast(case when p_partkey = 1 then 9 when p_partkey <= 3 or b in (0, 1, 2, 4, 5) then 6
                 when b = 3 then case when (p_partkey - 1) % 25 = 0 then 3 else 6 end
                 when k <= 5 or k = 8 then 6 when k = 6 then (p_size + 1) % 10 else p_size % 10 end as bigint) as decimals
from (select *, cast(floor((p_partkey - 1) / 25) as bigint) % 9 as b, p_partkey % 11 as k from {{part}}) s
"""

# Spark only.  Replies with the blobs above, p_partkey % 13: 0 none, 1 no account, 2 an id nobody asked for,
# 3 bad base64 and then the blob, else the blob.
METADATA_BATCHES_SQL = """
select batch, arr as body from """ + _array_of_replies("""
  select batch, xxhash64(i, batch) as place, case p_partkey % 13 when 0 then null
      when 1 then concat('{{"id":', i, ',"result":{{"value":null}}}}')
      when 2 then concat('{{"id":1000', i, ',"result":{{"value":{{"data":', data, '}}}}}}')
      when 3 then concat('{{"id":', i, ',"result":{{"value":{{"data":["!!!","base64"]}}}}}},{{"id":', i, ',"result":{{"value":{{"data":', data, '}}}}}}')
      else concat('{{"id":', i, ',"result":{{"value":{{"data":', data, '}}}}}}') end as reply
  from (select p_partkey, floor((p_partkey - 1) / 20) as batch, cast((p_partkey - 1) % 20 + 1 as string) as i,
               concat('[', coalesce(concat('"', replace(replace(blob, char(13), ''), char(10), ''), '"'), 'null'), ',"base64"]') as data from (""" + _BLOBS_SQL + """) m) s""") + " b"

EXPECTED_BATCH_METADATA_SQL = f"""
select {token_expr('p_partkey')} as mint,
  case when j <= 2 or k <= 3 then null else substring(p_brand, 1, 10) end as symbol,
  case when j <= 2 or k in (0, 1, 2, 4) then null when k = 6 then concat('\uFFFD', p_name) else p_name end as name,
  case when j <= 2 or k <= 2 then null else concat('https://m.example/', cast(p_partkey as string)) end as uri
from (select *, p_partkey % 11 as k, p_partkey % 13 as j from {{part}}) s
"""

RELATIONS = {
    "mints": MINTS_SQL,
    "burns": BURNS_SQL,
    "swaps": SWAPS_SQL,
    "token_decimals": TOKEN_DECIMALS_SQL,
    "decimals_responses": DECIMALS_RESPONSES_SQL,
}

#: relations that only Spark derives; the oracle knows what they should give
SPARK_RELATIONS = {
    "metadata_accounts": METADATA_ACCOUNTS_SQL,
    "decimals_requests": requests_sql(25), "decimals_batches": DECIMALS_BATCHES_SQL,
    "metadata_requests": requests_sql(20), "metadata_batches": METADATA_BATCHES_SQL,
}


def duckdb_ctes(names=None, extra: dict | None = None) -> str:
    """``WITH`` prefix defining the derived relations over the oracle's views."""
    chosen = dict(RELATIONS if names is None else {n: RELATIONS[n] for n in names})
    if extra:
        chosen.update(extra)
    parts = [f"{name} as ({sql.format(lineitem='lineitem', part='part').strip()})"
             for name, sql in chosen.items()]
    return "with " + ",\n".join(parts) + "\n"
