"""Payload flattening on small documents of every shape."""

import json
from decimal import Decimal

import pytest
from helpers import T0, rows

from statelake.sources import payloads

BIG = 31415926535897932384626433832
AT = 1_767_225_600  # a full hour


@pytest.fixture()
def landed(spark):
    def make(docs, **context):
        names = ", ".join(f"{k} {t}" for k, (t, _) in context.items())
        data = [(json.dumps(d) if not isinstance(d, str) else d, *[v for _, v in context.values()]) for d in docs]
        return spark.createDataFrame(data, "payload string" + (", " + names if names else ""))

    return make


TS = ("timestamp", T0)
CHAIN = ("int", 7)


def test_live_state_takes_numbers_and_text(landed):
    full = {"timestamp": str(AT), "supplyAssets": BIG, "supplyShares": str(BIG), "borrowAssets": 1, "borrowShares": "2", "utilization": 1, "price": 10**45}
    items = [
        {"marketId": "a", "chain": {"id": 7}, "state": full},
        {"marketId": "b", "chain": {"id": 7}, "state": None},
        {"marketId": "c", "chain": {"id": 7}, "state": {**full, "price": None, "rateAtTarget": "5", "timestamp": None}},
    ]
    a, c = rows(payloads.market_state_live(landed([{"items": items}], ts=TS)), "market_id")
    assert a["total_supply_assets"] == a["total_supply_shares"] == Decimal(BIG)
    assert a["oracle_price_raw"] == str(10**45) and a["rate_at_target"] is None and a["utilization"] == 1.0
    assert a["api_timestamp"].timestamp() == AT or a["api_timestamp"].hour == 0
    assert c["oracle_price_raw"] is None and c["rate_at_target"] == 5 and c["api_timestamp"] is None and c["source"] == "live"


def test_history_merges_series_by_hour(landed):
    series = {
        # out of order; the greatest x of an hour wins, the later listed among equals
        "supplyAssets": [{"x": AT + 1800, "y": "3"}, {"x": AT, "y": 1}, {"x": AT + 1800, "y": 4}, {"x": AT + 3600, "y": BIG}],
        "borrowAssets": [{"x": AT + 7200, "y": 9}],
        "rateAtTarget": None,
        "utilization": [{"x": AT + 10, "y": 0.5}, {"x": AT + 5, "y": 0.25}],
    }
    doc = {"marketId": "m", "creationTimestamp": 1, "historicalState": series}
    got = rows(payloads.market_state_history(landed([doc], chain_id=CHAIN)), "ts")
    assert [r["total_supply_assets"] for r in got] == [4, Decimal(BIG), None]
    assert [r["total_borrow_assets"] for r in got] == [None, None, 9]
    assert [r["utilization"] for r in got] == [0.5, None, None]
    assert {r["source"] for r in got} == {"backfill"} and all(r["rate_at_target"] is None for r in got)


def test_a_null_point_still_wins_its_hour(landed):
    doc = {"marketId": "m", "historicalState": {"utilization": [{"x": AT, "y": 0.5}, {"x": AT + 60, "y": None}]}}
    (r,) = rows(payloads.market_state_history(landed([doc], chain_id=CHAIN)))
    assert r["utilization"] is None


def test_idle_market_dimension(landed):
    loan = {"address": "0xAB", "symbol": "U", "decimals": 6}
    item = {"marketId": "m", "chain": {"id": 7}, "lltv": "0", "oracleAddress": None, "irmAddress": "0xCD", "creationTimestamp": AT, "listed": True, "loanAsset": loan, "collateralAsset": None}
    (r,) = rows(payloads.market_dimension(landed([{"items": [item]}], fetched_at=TS)))
    assert (r["loan_token"], r["irm"], r["oracle"], r["collateral_token"], r["collateral_decimals"], r["lltv"]) == ("0xab", "0xcd", None, None, None, 0)


def test_vault_without_allocations_gives_no_row(landed):
    slot = {"supplyAssets": "5", "supplyCap": 9, "market": {"marketId": "m"}}
    docs = [{"address": "0xA", "state": None}, {"address": "0xB", "state": {"allocation": []}}, {"address": "0xC", "state": {"allocation": [slot]}}]
    (r,) = rows(payloads.vault_allocations_live(landed(docs, chain_id=CHAIN, ts=TS)))
    assert (r["vault"], r["supply_assets"], r["supply_shares"], r["supply_cap"]) == ("0xc", 5, None, 9)


def test_allocation_history_takes_the_last_listed_point(landed):
    slot = {"market": {"marketId": "m"}, "supplyAssets": [{"x": AT + 900, "y": 1}, {"x": AT, "y": "2"}], "supplyCap": [{"x": AT + 3600, "y": 7}]}
    first, second = rows(payloads.vault_allocations_history(landed([{"address": "0xA", "historicalState": {"allocation": [slot]}}], chain_id=CHAIN)), "ts")
    assert (first["supply_assets"], first["supply_cap"], second["supply_assets"], second["supply_cap"]) == (2, None, None, 7)


def test_books_keep_real_holders(landed):
    def item(who, shares):
        return {"user": {"address": who}, "market": {"marketId": "m", "chain": {"id": 7}}, "healthFactor": None, "state": {"borrowShares": shares, "supplyShares": shares}}

    raw = landed([{"items": [item("0xA", "1"), item("0xB", 0), item("0xC", None)]}], ts=TS)
    assert [r["borrower"] for r in rows(payloads.borrower_positions(raw))] == ["0xa"]
    assert [r["supplier"] for r in rows(payloads.supplier_positions(raw))] == ["0xa"]


def test_flow_body_depends_on_its_tag(landed):
    head = {"txHash": "0xF", "logIndex": 1, "blockNumber": "5", "timestamp": AT, "user": {"address": "0xU"}, "market": {"marketId": "m", "chain": {"id": 7}}}
    liquidation = {"__typename": payloads.LIQUIDATION_TAG, "assets": 99, "repaidAssets": "3", "seizedAssets": 2, "badDebtAssets": 0, "liquidator": "0xQ"}
    items = [{**head, "type": "Liquidation", "data": liquidation}, {**head, "type": "Supply", "logIndex": 2, "data": {"__typename": "X", "assets": 4, "shares": "6"}}, {**head, "type": "Odd", "logIndex": 3, "data": None}]
    liq, sup, odd = rows(payloads.market_flows(landed([{"items": items}])), "log_index")
    assert (liq["assets"], liq["repaid_assets"], liq["bad_debt_assets"], liq["liquidator"]) == (None, 3, 0, "0xq")
    assert (sup["assets"], sup["shares"], sup["liquidator"], sup["tx_hash"]) == (4, 6, None, "0xf")
    assert odd["assets"] is None and odd["block_number"] == 5


def test_vault_flows_exclude_transfers(landed):
    head = {"txHash": "0xF", "blockNumber": 5, "timestamp": str(AT), "assets": "7", "shares": 8, "vault": {"address": "0xV", "chain": {"id": 7}}}
    items = [{**head, "logIndex": i, "type": k, "data": {"sender": "0xS", "receiver": None, "onBehalf": ""}} for i, k in enumerate(["Deposit", "Withdraw", "Transfer"])]
    got = rows(payloads.vault_v2_flows(landed([{"items": items}])), "log_index")
    assert [r["type"] for r in got] == ["Deposit", "Withdraw"] and got[0]["sender"] == "0xs" and got[0]["on_behalf"] is None


def test_current_prices_by_slug(landed):
    coins = {"alpha:0xA": {"price": 1, "confidence": 0.9}, "beta:0xB": {"price": None}, "gamma:0xC": {"price": 2}, "alpha:x:Y": {"price": 3}}
    got = rows(payloads.prices_current(landed([{"coins": coins}], ts=TS), {"alpha": 1, "beta": 2}), "token_address")
    assert [(r["chain_id"], r["token_address"], r["price_usd"], r["confidence"]) for r in got] == [(1, "0xa", 1.0, 0.9), (1, "x:y", 3.0, None)]


def test_hourly_histories(landed):
    chart = {"prices": [{"timestamp": AT, "price": 1.0, "confidence": 0.5}, {"timestamp": AT + 60, "price": None}, {"timestamp": AT + 30, "price": 2.0}]}
    (r,) = rows(payloads.prices_chart(landed([chart], chain_id=CHAIN, address=("string", "0xA"))))
    assert (r["price_usd"], r["confidence"], r["token_address"]) == (2.0, None, "0xa")
    other = {"address": "0xA", "historicalPriceUsd": [{"x": AT, "y": 1.0}, {"x": AT + 3600, "y": 5.0}, {"x": AT + 1, "y": None}]}
    got = rows(payloads.prices_fallback_history(landed([other, {"address": "0xB", "historicalPriceUsd": None}], chain_id=CHAIN)), "ts")
    assert [r["price_usd"] for r in got] == [1.0, 5.0]


def test_pools_universe_and_vault_state(landed):
    pools = {"data": [{"pool": "p", "chain": "A", "project": "x", "tvlUsd": 1, "apy": 2.5}, {"pool": "q", "chain": "B", "project": "x"}]}
    (p,) = rows(payloads.yield_pools(landed([pools], ts=TS), ["A"]))
    assert (p["pool_id"], p["tvl_usd"], p["apy_reward"]) == ("p", 1.0, None)
    items = [{"marketId": "a", "state": {"supplyAssetsUsd": 5}}, {"marketId": "b", "state": None}]
    got = rows(payloads.market_universe(landed([{"items": items}], chain_id=CHAIN)), "market_id")
    assert [r["supply_usd"] for r in got] == [5.0, 0.0]
    (v,) = rows(payloads.vault_v2_state(landed([{"address": "0xV", "chain": {"id": 7}, "totalAssets": str(BIG), "sharePrice": 1}], ts=TS)))
    assert v["total_assets"] == Decimal(BIG) and v["share_price"] == 1.0 and v["idle_assets"] is None
