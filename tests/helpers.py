"""Rows of the stored tables, with few columns named."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

T0 = datetime(2026, 3, 2, 0, 0, tzinfo=timezone.utc)
CHAIN = 7


def hours(n: float) -> timedelta:
    return timedelta(hours=n)


def dim(market: str, collateral: str | None = "COL", **more) -> dict:
    return {
        "chain_id": CHAIN, "market_id": market, "loan_token": "0xloan", "loan_symbol": "USD", "loan_decimals": 6,
        "collateral_token": "0xcoll" if collateral else None, "collateral_symbol": collateral,
        "collateral_decimals": 18 if collateral else None, "lltv": 915 * 10**15, "creation_ts": T0, "listed": True,
        "fetched_at": T0, **more,
    }


def state(market: str, ts: datetime, u: float | None, supply: int = 10**12, rate: int | None = 2_600_000_000, **more) -> dict:
    return {
        "ts": ts, "chain_id": CHAIN, "market_id": market, "total_supply_assets": supply, "total_supply_shares": supply,
        "total_borrow_assets": int(supply * (u or 0)), "total_borrow_shares": 0, "rate_at_target": rate, "utilization": u,
        "source": "live", **more,
    }


def price(token: str, ts: datetime, usd: float, **more) -> dict:
    return {"ts": ts, "chain_id": CHAIN, "token_address": token, "price_usd": usd, "source": "llama", **more}


def allocation(market: str, ts: datetime, amount: int, cap: int | None = None, vault: str = "0xv") -> dict:
    return {"ts": ts, "chain_id": CHAIN, "vault": vault, "market_id": market, "supply_assets": amount, "supply_cap": cap, "source": "live"}


def flow(ts: datetime, kind: str, i: int, market: str = "m", **amounts) -> dict:
    return {
        "ts": ts, "chain_id": CHAIN, "market_id": market, "block_number": 1000 + i, "tx_hash": f"0x{i}", "log_index": i,
        "type": kind, "account": "0xuser", **amounts,
    }


def rows(df, *order: str) -> list[dict]:
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
