"""Brute-force model of the per-token record, in plain Python.

the same fixed tie orders the Spark operators use.  Used on small random
inputs only.
"""

from __future__ import annotations

from collections import defaultdict

from ledgerlens.constants import SOL, USDC, USDT

ANCHORS = {SOL, USDC, USDT}
STABLE = {USDC, USDT}
PRESET = {SOL: 9, USDC: 6, USDT: 6}


def canon(source: str) -> str:
    def like(prefix: str) -> bool:   # '_' is a one-character wildcard
        if len(source) < len(prefix):
            return False
        return all(p == "_" or p == c for p, c in zip(prefix, source))
    if like("jupiter6_") or like("jupiter4_"):
        return source[9:]
    if like("raydium_route_"):
        return source[14:]
    return source


def scale_once(n: int, d: int) -> float:
    return float(f"{n}e-{d}")


# SURVEY 2, P7: which side values a pool, and at what, is the first rule that holds.
VALUE_RULES = [(side, coins) for coins in ({SOL}, STABLE) for side in (0, 1)]


def pool_value(sides, sol):
    """Twice the value of the side that a rule names; 0 without one."""
    for side, coins in VALUE_RULES:
        coin, amount = sides[side]
        if coin in coins:
            return amount * sol * 2.0 if coin == SOL else amount * 2.0
    return 0.0


def records(mints, burns, swaps, decimals, sol=190.0):
    """mints/burns: (mint, amount, time); swaps: (source, base, quote, base_amt,
    quote_amt, base_bal, quote_bal, time); decimals: {mint: d}."""
    tokens = sorted({m for m, _, _ in mints if m})
    tset = set(tokens)
    dec = {t: PRESET.get(t, decimals.get(t, 6)) for t in tokens}
    minted, burned = defaultdict(int), defaultdict(int)
    first = {}
    for m, a, t in mints:
        if m in tset:
            minted[m] += a
            if t is not None:
                first[m] = min(first.get(m, t), t)
    for m, a, _ in burns:
        burned[m] += a
    for s in swaps:
        for side in (s[1], s[2]):
            if side in tset and s[7] is not None:
                first[side] = min(first.get(side, s[7]), s[7])
    # latest state per pool over anchor swaps
    latest = {}
    for s in swaps:
        if s[1] not in ANCHORS and s[2] not in ANCHORS:
            continue
        key = (canon(s[0]), s[1], s[2])
        cand = (s[7], s[5], s[6])
        if key not in latest or cand > latest[key]:
            latest[key] = cand
    offered = defaultdict(list)
    for (src, base, quote), (_, bb, qb) in latest.items():
        if not (bb > 0 and qb > 0):
            continue
        if not ((base in tset and quote in ANCHORS) or (quote in tset and base in ANCHORS)):
            continue
        bd = dec.get(base, 9 if base == SOL else 6)
        qd = dec.get(quote, 9 if quote == SOL else 6)
        bn, qn = float(bb) / 10 ** bd, float(qb) / 10 ** qd
        liq = pool_value([(base, bn), (quote, qn)], sol)
        bonding = "bondingcurve" in src.lower()
        for is_base, tok in ((True, base), (False, quote)):
            if tok in tset:
                offered[tok].append(dict(src=src, base=base, quote=quote, bn=bn, qn=qn, liq=liq,
                                         bonding=bonding, is_base=is_base,
                                         own=bb if is_base else qb))
    out = {}
    for t in tokens:
        first_tx = first.get(t)
        supply = max(0.0, scale_once(minted[t] - burned[t], dec[t]))
        pools = offered.get(t, [])
        reserves = scale_once(sum(p["own"] for p in pools), dec[t]) if pools else 0.0
        price = liq = 0.0
        source = ""
        if pools:
            best = min(pools, key=lambda p: (p["bonding"], -p["liq"], p["src"], p["base"], p["quote"],
                                             not p["is_base"]))
            source, liq = best["src"], best["liq"]
            sides = [(best["base"], best["bn"]), (best["quote"], best["qn"])]
            (_, own), (other, amount) = sides if sides[0][0] == t else sides[::-1]
            if own > 0 and amount > 0:
                price = amount * (sol if other == SOL else 1.0) / own
        if first_tx is None:
            continue
        out[t] = dict(price_usd=price, supply=supply, burned=scale_once(burned[t], dec[t]),
                      largest_lp_pool_usd=liq, source=source, first_tx_date=first_tx,
                      market_cap_usd=price * max(0.0, supply - reserves))
    return out


def latest_sol_prices(swaps, tokens):
    """{token: price in SOL of its latest trade with a non-null price, or None}
    for tokens with at least one trade against SOL."""
    trades = defaultdict(list)
    for s in swaps:
        base, quote, ba, qa, t = s[1], s[2], s[3], s[4], s[7]
        if quote == SOL:
            trades[base].append((t, float(qa) / float(ba) if float(ba) != 0 else None))
        if base == SOL:
            trades[quote].append((t, float(ba) / float(qa) if float(qa) != 0 else None))
    out = {}
    for tok, rows in trades.items():
        if tok not in tokens:
            continue
        priced = [r for r in rows if r[1] is not None]
        out[tok] = max(priced)[1] if priced else None
    return out


def recent_trade_prices(swaps, tokens, sol=190.0, n=100):
    """{token: (liquidity, price)} from the best of its n latest swaps.

    P9: a swap's liquidity adds the first SOL side (at the SOL price) and the first
    stable side.  A12: the highest positive one wins, the most recent on ties.
    P10: its price is counter amount over own amount at the counter's unit value."""
    def first(sides, coins):
        return next((balance for coin, balance in sides if coin in coins), 0.0)

    unit = {SOL: sol, USDC: 1.0, USDT: 1.0}
    out = {}
    for tok in tokens:
        own = sorted((s for s in swaps if tok in (s[1], s[2])),
                     key=lambda s: (s[7], s[1], s[2], s[5], s[6], s[3], s[4]), reverse=True)[:n]
        scored = []
        for place, s in enumerate(own):
            sides = [(s[1], float(s[5])), (s[2], float(s[6]))]
            scored.append((first(sides, {SOL}) * sol + first(sides, STABLE), -place, s))
        good = [x for x in scored if x[0] > 0]
        if not good:
            out[tok] = (0.0, 0.0)
            continue
        liquidity, _, s = max(good, key=lambda x: x[:2])
        amounts = [(s[1], float(s[3])), (s[2], float(s[4]))]
        (_, mine), (other, theirs) = amounts if s[1] == tok else amounts[::-1]
        price = theirs / mine * unit.get(other, 0.0) if mine and theirs else 0.0
        out[tok] = (liquidity, price)
    return out
