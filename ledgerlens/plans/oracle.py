"""DuckDB oracle SQL for every registered query.

Independent, plain-SQL statements of each operator's semantics over the
same derived relations (``sources.fixtures``), written the way the
reference's statements and dict logic read: UNION ALL instead of generators,
IN-subqueries for membership, row_number() for the fixed tie orders.
Double constants carry an exponent (``190.0e0``) so they are DOUBLE, not
DECIMAL, in both engines.
"""

from __future__ import annotations

from ..constants import SOL, USDC, USDH, USDT
from ..sources import fixtures

A = f"('{SOL}', '{USDC}', '{USDT}')"
STABLE = f"('{USDC}', '{USDT}')"
P = "190.0e0"
P_REPRICED = "150.0e0"


def _exact(raw: str, d: str) -> str:
    return f"cast(concat(cast(cast({raw} as decimal(38,0)) as varchar), 'e-', cast({d} as varchar)) as double)"


def _preset(col: str) -> str:
    return f"case {col} when '{SOL}' then 9 when '{USDC}' then 6 when '{USDT}' then 6 end"


VALID = "mint is not null and mint <> ''"

BASE_CTES = f"""
tokens as (select distinct mint from mints where {VALID}),
dec_map as (
  select t.mint, cast(coalesce({_preset('t.mint')}, d.decimals, 6) as integer) as decimals
  from tokens t left join token_decimals d on d.mint = t.mint),
minted as (select mint, cast(sum(amount) as decimal(38,0)) as minted_raw
           from mints where {VALID} group by mint),
burned as (select mint, cast(sum(amount) as decimal(38,0)) as burned_raw
           from burns where {VALID} group by mint),
first_mint as (select mint, min(block_time) as first_mint from mints where {VALID}
               group by mint having min(block_time) is not null),
swap_sides as (select base_coin as mint, block_time from swaps
               union all select quote_coin as mint, block_time from swaps),
first_swap as (select mint, min(block_time) as first_swap from swap_sides where {VALID}
               group by mint having min(block_time) is not null),
latest as (
  select canonical_source, base_coin, quote_coin, block_time as last_block_time,
         base_pool_balance_after as last_base_balance, quote_pool_balance_after as last_quote_balance
  from (select *, row_number() over (partition by canonical_source, base_coin, quote_coin
                  order by block_time desc, base_pool_balance_after desc, quote_pool_balance_after desc) as rn
        from (select case when source like 'jupiter6_%' then substring(source, 10)
                          when source like 'jupiter4_%' then substring(source, 10)
                          when source like 'raydium_route_%' then substring(source, 15)
                          else source end as canonical_source, *
              from swaps
              where (base_coin in {A} or quote_coin in {A}) and block_time is not null
                and base_pool_balance_after is not null and quote_pool_balance_after is not null) x) y
  where rn = 1),
cand as (
  select canonical_source, base_coin, quote_coin, last_block_time, last_base_balance, last_quote_balance
  from latest
  where last_base_balance > 0 and last_quote_balance > 0
    and ((base_coin in (select mint from tokens) and quote_coin in {A})
      or (quote_coin in (select mint from tokens) and base_coin in {A}))),
sides0 as (
  select c.*, c.base_coin as mint, true as token_is_base from cand c
   where c.base_coin in (select mint from tokens)
  union all
  select c.*, c.quote_coin as mint, false as token_is_base from cand c
   where c.quote_coin in (select mint from tokens)),
sides1 as (
  select s.*, dt.decimals as token_decimals,
         cast(coalesce(db.decimals, case when s.base_coin = '{SOL}' then 9 else 6 end) as integer) as base_decimals,
         cast(coalesce(dq.decimals, case when s.quote_coin = '{SOL}' then 9 else 6 end) as integer) as quote_decimals
  from sides0 s join dec_map dt on dt.mint = s.mint
  left join dec_map db on db.mint = s.base_coin
  left join dec_map dq on dq.mint = s.quote_coin),
sides2 as (
  select *, cast(last_base_balance as double) / pow(10, base_decimals) as base_balance_norm,
            cast(last_quote_balance as double) / pow(10, quote_decimals) as quote_balance_norm
  from sides1)
"""


def _sides(price: str) -> str:
    return f""",
sides as (
  select *,
    case when base_coin = '{SOL}' then base_balance_norm * {price} * 2.0e0
         when quote_coin = '{SOL}' then quote_balance_norm * {price} * 2.0e0
         when base_coin in {STABLE} then base_balance_norm * 2.0e0
         when quote_coin in {STABLE} then quote_balance_norm * 2.0e0
         else 0.0e0 end as liquidity_usd,
    contains(lower(canonical_source), 'bondingcurve') as is_bonding,
    case when base_balance_norm > 0 and quote_balance_norm > 0 then
      case when mint = base_coin
           then (quote_balance_norm * (case when quote_coin = '{SOL}' then {price} else 1.0e0 end)) / base_balance_norm
           else (base_balance_norm * (case when base_coin = '{SOL}' then {price} else 1.0e0 end)) / quote_balance_norm end
    else 0.0e0 end as price_usd
  from sides2),
best as (
  select mint, canonical_source as source, liquidity_usd, price_usd
  from (select *, row_number() over (partition by mint order by is_bonding asc, liquidity_usd desc,
               canonical_source asc, base_coin asc, quote_coin asc, token_is_base desc) as rn
        from sides) z where rn = 1),
reserves as (
  select mint, {_exact('sum(case when token_is_base then last_base_balance else last_quote_balance end)', 'token_decimals')} as reserves
  from sides group by mint, token_decimals),
supply as (
  select t.mint, d.decimals,
         coalesce(m.minted_raw, 0) as minted_raw, coalesce(b.burned_raw, 0) as burned_raw,
         greatest(0.0e0, {_exact('coalesce(m.minted_raw, 0) - coalesce(b.burned_raw, 0)', 'd.decimals')}) as supply
  from tokens t join dec_map d on d.mint = t.mint
  left join minted m on m.mint = t.mint left join burned b on b.mint = t.mint)
"""


def _with(extra: str = "", price: str = P, relations=None) -> str:
    head = fixtures.duckdb_ctes(relations).rstrip()
    return f"{head},\n{BASE_CTES.strip()}{_sides(price)}{extra}\n"


SOL_TRADES = f"""
sol_trades as (
  select base_coin as mint, block_time,
         cast(quote_coin_amount as double) / nullif(cast(base_coin_amount as double), 0) as price
  from swaps where quote_coin = '{SOL}'
  union all
  select quote_coin as mint, block_time,
         cast(base_coin_amount as double) / nullif(cast(quote_coin_amount as double), 0) as price
  from swaps where base_coin = '{SOL}'),
last_sol_price as (
  select g.mint, l.price as last_price_in_sol
  from (select distinct mint from sol_trades where {VALID}) g
  left join (select mint, price, row_number() over (partition by mint order by block_time desc, price desc) as rn
             from sol_trades where price is not null) l on l.mint = g.mint and l.rn = 1
  where g.mint in (select mint from tokens))"""

RECENT = f"""
recent as (
  select * from (
    select *, row_number() over (partition by mint order by block_time desc, base_coin desc, quote_coin desc,
              base_pool_balance_after desc, quote_pool_balance_after desc, base_coin_amount desc,
              quote_coin_amount desc) as recency_rank
    from (select base_coin as mint, * from swaps
          union all
          select quote_coin as mint, * from swaps where quote_coin <> base_coin) s
    where {VALID}) r
  where recency_rank <= 100 and mint in (select mint from tokens))"""

TRADE_LIQ = f"""(case when base_coin = '{SOL}' then cast(base_pool_balance_after as double) * {P}
      when quote_coin = '{SOL}' then cast(quote_pool_balance_after as double) * {P} else 0.0e0 end
 + case when base_coin in {STABLE} then cast(base_pool_balance_after as double)
        when quote_coin in {STABLE} then cast(quote_pool_balance_after as double) else 0.0e0 end)"""

TRADE_PRICE = f"""case when cast(base_coin_amount as double) = 0 or cast(quote_coin_amount as double) = 0 then 0.0e0
  when mint = base_coin then
    case when quote_coin = '{SOL}' then (cast(quote_coin_amount as double) / cast(base_coin_amount as double)) * {P}
         when quote_coin in {STABLE} then cast(quote_coin_amount as double) / cast(base_coin_amount as double)
         else 0.0e0 end
  when mint = quote_coin then
    case when base_coin = '{SOL}' then (cast(base_coin_amount as double) / cast(quote_coin_amount as double)) * {P}
         when base_coin in {STABLE} then cast(base_coin_amount as double) / cast(quote_coin_amount as double)
         else 0.0e0 end
  else 0.0e0 end"""

BEST_TRADE = f"""
scored as (select *, {TRADE_LIQ} as liquidity from recent),
best_trade as (
  select mint, liquidity, {TRADE_PRICE} as price_usd
  from (select *, row_number() over (partition by mint order by liquidity desc, recency_rank asc) as rn2
        from scored where liquidity > 0) q where rn2 = 1)"""

EXPECTED = {"expected_decimals": fixtures.EXPECTED_DECIMALS_SQL,
            "expected_metadata": fixtures.EXPECTED_METADATA_SQL}


def _pipeline(dec_table: str, meta: str | None) -> str:
    meta_cols = ("m.symbol, m.name, m.uri" if meta else
                 "cast(null as varchar) as symbol, cast(null as varchar) as name, cast(null as varchar) as uri")
    meta_join = f"left join {meta} m on m.mint = t.mint" if meta else ""
    return f"""
select t.mint as token_address, 'solana' as blockchain, {meta_cols.split(',')[0]},
       coalesce(bp.price_usd, 0.0e0) as price_usd,
       coalesce(bp.price_usd, 0.0e0) * greatest(0.0e0, s.supply - coalesce(r.reserves, 0.0e0)) as market_cap_usd,
       s.supply,
       {_exact('coalesce(b.burned_raw, 0)', 's.decimals')} as burned,
       coalesce(bp.liquidity_usd, 0.0e0) as largest_lp_pool_usd,
       least(fm.first_mint, fs.first_swap) as first_tx_date,
       coalesce(bp.source, '') as source, {', '.join(meta_cols.split(',')[1:]).strip()}
from tokens t
join supply s on s.mint = t.mint
left join burned b on b.mint = t.mint
left join first_mint fm on fm.mint = t.mint
left join first_swap fs on fs.mint = t.mint
left join best bp on bp.mint = t.mint
left join reserves r on r.mint = t.mint
{meta_join}
where least(fm.first_mint, fs.first_swap) is not null"""


def _enriched_prefix(price: str = P) -> str:
    """Same CTEs with token_decimals replaced by the expected decimals of the
    captured replies (what the Spark side parses out of the JSON)."""
    head = fixtures.duckdb_ctes(
        ["mints", "burns", "swaps"],
        extra={"token_decimals": fixtures.EXPECTED_DECIMALS_SQL, **{"expected_metadata": fixtures.EXPECTED_METADATA_SQL}}).rstrip()
    return f"{head},\n{BASE_CTES.strip()}{_sides(price)}\n"


ORACLE: dict[str, str] = {
    "token_discovery": _with() + "select mint from tokens",
    "normalized_keys": fixtures.duckdb_ctes(["mints", "burns", "swaps"]) + """
select mint, cast(sum(m) as bigint) as n_mint_rows, cast(sum(b) as bigint) as n_burn_rows,
       cast(sum(s) as bigint) as n_swap_sides
from (select mint, 1 as m, 0 as b, 0 as s from mints
      union all select mint, 0, 1, 0 from burns
      union all select base_coin, 0, 0, 1 from swaps
      union all select quote_coin, 0, 0, 1 from swaps) k
group by mint""",
    "canonical_source_counts": fixtures.duckdb_ctes(["swaps"]) + """
select case when source like 'jupiter6_%' then substring(source, 10)
            when source like 'jupiter4_%' then substring(source, 10)
            when source like 'raydium_route_%' then substring(source, 15)
            else source end as canonical_source, count(*) as n_swaps
from swaps group by 1""",
    "pool_class_counts": _with() + """
select case when contains(lower(canonical_source), 'bondingcurve') then 'bonding' else 'priority' end as pool_class,
       count(*) as n_pools
from latest where last_base_balance > 0 and last_quote_balance > 0 group by 1""",
    "minted_by_token": _with() + "select mint, minted_raw from minted",
    "burned_by_token": _with() + "select mint, burned_raw from burned where mint in (select mint from tokens)",
    "token_discovery_limited": _with() + "select mint from tokens order by mint limit 100",
    "token_supply_static": _with() + f"""
select s.mint, x.d as decimals, s.minted_raw, s.burned_raw,
       greatest(0.0e0, {_exact('s.minted_raw - s.burned_raw', 'x.d')}) as supply
from supply s join (select mint, cast(case when mint = '{SOL}' then 9 when mint in ('{USDC}', '{USDT}', '{USDH}') then 6
                                      else 9 end as integer) as d from tokens) x on x.mint = s.mint""",
    "token_metrics_from_files": _with() + _pipeline("token_decimals", None),
    "token_supply": _with() + "select mint, decimals, minted_raw, burned_raw, supply from supply",
    "token_supply_point": fixtures.duckdb_ctes(["mints", "burns"]) + f"""
select '{SOL}' as mint,
       greatest(cast(0 as decimal(38,0)),
                cast((select coalesce(sum(amount), 0) from mints where mint = '{SOL}') as decimal(38,0))
              - cast((select coalesce(sum(amount), 0) from burns where mint = '{SOL}') as decimal(38,0))) as supply_raw""",
    "initial_minted_normalized": _with() + f"""
select mint, minted_raw,
       cast(minted_raw as double) / pow(10, case when mint in ('{SOL}') then 9
            when mint in ('{USDC}', '{USDT}', '{USDH}') then 6 else 9 end)
         as initial_minted_normalized
from minted""",
    "burned_normalized": _with() + f"""
select d.mint, {_exact('coalesce(b.burned_raw, 0)', 'd.decimals')} as burned
from dec_map d left join burned b on b.mint = d.mint""",
    "first_mints": _with() + "select mint, first_mint from first_mint where mint in (select mint from tokens)",
    "first_swaps": _with() + "select mint, first_swap from first_swap where mint in (select mint from tokens)",
    "first_tx_dates": _with() + """
select t.mint, fm.first_mint, fs.first_swap, least(fm.first_mint, fs.first_swap) as first_tx_date
from tokens t left join first_mint fm on fm.mint = t.mint left join first_swap fs on fs.mint = t.mint""",
    "first_tx_point": fixtures.duckdb_ctes(["mints", "swaps"]) + f"""
select '{SOL}' as mint,
       least((select min(block_time) from mints where mint = '{SOL}'),
             (select min(block_time) from swaps where base_coin = '{SOL}' or quote_coin = '{SOL}')) as first_tx_date""",
    "latest_pool_state": _with() + """
select canonical_source, base_coin, quote_coin, last_block_time, last_base_balance, last_quote_balance from latest""",
    "candidate_pools": _with() + """
select canonical_source, base_coin, quote_coin, last_base_balance, last_quote_balance from cand""",
    "pool_sides": _with() + """
select mint, canonical_source, base_coin, quote_coin, token_is_base, token_decimals, base_decimals, quote_decimals
from sides""",
    "pool_balances": _with() + """
select distinct canonical_source, base_coin, quote_coin, base_decimals, quote_decimals,
       base_balance_norm, quote_balance_norm from sides""",
    "pool_liquidity": _with() + """
select distinct canonical_source, base_coin, quote_coin, is_bonding, liquidity_usd from sides""",
    "best_pool_metrics": _with() + """
select t.mint, coalesce(b.source, '') as source, coalesce(b.liquidity_usd, 0.0e0) as liquidity_usd,
       coalesce(b.price_usd, 0.0e0) as price_usd
from tokens t left join best b on b.mint = t.mint""",
    "best_pool_metrics_repriced": _with(price=P_REPRICED) + """
select t.mint, coalesce(b.source, '') as source, coalesce(b.liquidity_usd, 0.0e0) as liquidity_usd,
       coalesce(b.price_usd, 0.0e0) as price_usd
from tokens t left join best b on b.mint = t.mint""",
    "token_reserves": _with() + """
select t.mint, coalesce(r.reserves, 0.0e0) as reserves from tokens t left join reserves r on r.mint = t.mint""",
    "circulating_supply": _with() + """
select s.mint, s.supply, coalesce(r.reserves, 0.0e0) as reserves,
       greatest(0.0e0, s.supply - coalesce(r.reserves, 0.0e0)) as circulating_supply
from supply s left join reserves r on r.mint = s.mint""",
    "market_caps": _with("," + SOL_TRADES) + f"""
select s.mint, s.supply, coalesce(coalesce(p.last_price_in_sol * {P}, 0.0e0), 0.0e0) as price_usd,
       s.supply * coalesce(coalesce(p.last_price_in_sol * {P}, 0.0e0), 0.0e0) as market_cap_usd
from supply s left join last_sol_price p on p.mint = s.mint""",
    "latest_price_in_sol": _with("," + SOL_TRADES) + "select mint, last_price_in_sol from last_sol_price",
    "prices_in_usd": _with("," + SOL_TRADES) + f"""
select mint, coalesce(last_price_in_sol * {P}, 0.0e0) as price_usd from last_sol_price""",
    "recent_swaps": _with("," + RECENT) + """
select mint, cast(recency_rank as integer) as recency_rank, base_coin, quote_coin, base_pool_balance_after,
       quote_pool_balance_after, base_coin_amount, quote_coin_amount, block_time from recent""",
    "trade_liquidity": fixtures.duckdb_ctes(["swaps"]) + f"""
select base_coin, quote_coin, block_time, base_pool_balance_after, quote_pool_balance_after,
       {TRADE_LIQ} as liquidity from swaps""",
    "recent_trade_price": _with("," + RECENT + "," + BEST_TRADE) + """
select t.mint, coalesce(b.liquidity, 0.0e0) as liquidity, coalesce(b.price_usd, 0.0e0) as price_usd
from tokens t left join best_trade b on b.mint = t.mint""",
    "decimals_from_responses": fixtures.duckdb_ctes([], extra={"expected_decimals": fixtures.EXPECTED_DECIMALS_SQL})
    + "select mint, decimals from expected_decimals",
    "account_metadata": fixtures.duckdb_ctes([], extra={"expected_metadata": fixtures.EXPECTED_METADATA_SQL})
    + "select mint, symbol, name, uri from expected_metadata",
    "decimals_from_batches": fixtures.duckdb_ctes([], extra={"expected": fixtures.EXPECTED_BATCH_DECIMALS_SQL})
    + "select mint, decimals from expected",
    "metadata_from_batches": fixtures.duckdb_ctes([], extra={"expected": fixtures.EXPECTED_BATCH_METADATA_SQL})
    + "select mint, symbol, name, uri from expected",
    "token_metrics": _with() + _pipeline("token_decimals", None),
    "token_metrics_limited": _with().replace(
        "tokens as (select distinct mint from mints where " + VALID + ")",
        "tokens as (select distinct mint from mints where " + VALID + " order by mint limit 100)") + _pipeline("token_decimals", None),
    "recent_swaps_point": _with("," + RECENT) + f"""
select mint, base_coin, quote_coin, base_pool_balance_after, quote_pool_balance_after, base_coin_amount, quote_coin_amount, block_time
from recent where mint = '{SOL}'""",
    "token_price_point": _with("," + RECENT + "," + BEST_TRADE) + f"""
select '{SOL}' as mint, coalesce(max(liquidity), 0.0e0) as liquidity, coalesce(max(price_usd), 0.0e0) as price_usd
from best_trade where mint = '{SOL}'""",
    "token_metrics_enriched": _enriched_prefix() + _pipeline("token_decimals", "expected_metadata"),
    "run_summary": _enriched_prefix() + """
select count(*) as tokens_found, count(m.symbol) as tokens_with_symbol,
       count(least(fm.first_mint, fs.first_swap)) as records
from tokens t
left join expected_metadata m on m.mint = t.mint
left join first_mint fm on fm.mint = t.mint
left join first_swap fs on fs.mint = t.mint""",
}
