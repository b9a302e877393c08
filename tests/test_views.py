"""Views on tiny tables with values worked out by hand."""

import math

import pytest
from helpers import CHAIN, T0, allocation, dim, flow, hours, price, rows, state
from pyspark.sql import functions as F

from statelake.plans import book_views, flow_views, market_views, price_views, spell_views, vault_views


def test_state_scaling(table):
    raw = "41375250000000000000000000"
    t = {
        "market_state": table("market_state", [state("m", T0, 0.5, supply=1_000_000, oracle_price_raw=raw)]),
        "markets": table("markets", [dim("m")]),
    }
    (r,) = rows(market_views.v_market_state(t))
    assert r["supply_assets"] == 1.0 and r["borrow_assets"] == 0.5 and r["liquidity"] == 0.5
    assert r["oracle_price"] == pytest.approx(41.37525, rel=1e-12)
    assert r["lltv"] == pytest.approx(0.915)
    assert r["apy_at_target"] == pytest.approx(math.exp(2.6e9 / 1e18 * 31536000) - 1, rel=1e-12)


def test_market_without_dimension_keeps_its_rows(table):
    t = {"market_state": table("market_state", [state("m", T0, 0.5)]), "markets": table("markets", [])}
    (r,) = rows(market_views.v_market_state(t))
    assert r["supply_assets"] is None and r["utilization"] == 0.5


def test_liquidity_risk_and_snapshot(table):
    t = {
        "market_state": table("market_state", [state("m", T0, 0.98), state("m", T0 + hours(1), 1.0), state("m", T0 + hours(2), None, rate=None)]),
        "markets": table("markets", [dim("m")]),
    }
    (r,) = rows(market_views.v_liquidity_risk(t))
    assert r["hours_observed"] == 3
    assert r["pct_time_gt95"] == pytest.approx(200 / 3)  # unknown counts as not above
    assert r["pct_time_gt99"] == pytest.approx(100 / 3)
    assert r["avg_util_pct"] == pytest.approx(99.0)  # unknown is ignored
    assert r["current_util_pct"] == 100.0  # newest known value
    (s,) = rows(market_views.v_market_snapshot(t))
    assert s["ts"].hour == 2 and s["utilization"] is None


def test_regime_windows_end_at_the_anchor(table, spark):
    t = {
        "market_state": table("market_state", [state("m", T0, 0.97), state("m", T0 + hours(24 * 20), 0.5)]),
        "markets": table("markets", [dim("m")]),
    }
    at = lambda h: F.lit(T0 + hours(h)).cast("timestamp")
    (late,) = rows(market_views.v_utilization_regime(t, at(24 * 60)))
    assert late["avg_util_7d"] is None and late["current_util_pct"] == 50.0
    (r,) = rows(market_views.v_utilization_regime(t, at(24 * 20)))
    assert r["avg_util_7d"] == pytest.approx(50.0) and r["avg_util_30d"] == pytest.approx(73.5)
    (edge,) = rows(market_views.v_utilization_regime(t, at(24 * 27)))
    assert edge["avg_util_7d"] is None  # exactly seven days ago is outside


def test_vault_snapshot_and_drift(table):
    t = {
        "vault_allocations": table("vault_allocations", [
            allocation("a", T0, 100_000_000), allocation("b", T0, 100_000_000),
            allocation("a", T0 + hours(1), 300_000_000, 10_000_000_000), allocation("b", T0 + hours(1), 100_000_000, 0),
        ]),
        "markets": table("markets", [dim("a"), dim("b", None)]),
    }
    a, b = rows(vault_views.v_vault_snapshot(t), "market_id")
    assert (a["weight_pct"], a["cap_used_pct"], b["weight_pct"], b["cap_used_pct"]) == (75.0, 3.0, 25.0, None)
    assert b["collateral_symbol"] == "IDLE"
    up, down = rows(vault_views.v_vault_drift(t), "market_id")
    assert (up["weight_change_pct"], up["supply_assets_change"]) == (25.0, 200.0)
    assert (down["weight_change_pct"], down["supply_assets_change"], down["prev_weight_pct"]) == (-25.0, 0.0, 50.0)


def test_position_risk_uses_the_newest_snapshot(table):
    def pos(who, debt, hf, ts=T0 + hours(1)):
        return {"ts": ts, "chain_id": CHAIN, "market_id": "m", "borrower": who, "borrow_assets": debt, "health_factor": hf}

    book = [pos("a", 600_000, 1.02), pos("b", 300_000, 2.5), pos("c", 100_000, 8.0), pos("x", None, None), pos("old", 9, 1.0, T0)]
    t = {"positions": table("positions", book), "markets": table("markets", [dim("m")])}
    (r,) = rows(book_views.v_position_risk(t))
    assert r["borrowers"] == 4 and r["total_borrow"] == 1.0 and r["borrowers_hf_lt_105"] == 1
    assert r["pct_debt_hf_lt_105"] == pytest.approx(60.0) and r["top3_debt_pct"] == pytest.approx(100.0)
    assert r["min_hf"] == 1.02


def test_supplier_concentration(table):
    book = [
        {"ts": T0, "chain_id": CHAIN, "market_id": "m", "supplier": s, "supply_assets": a}
        for s, a in (("s1", 80_000), ("s2", 15_000), ("s3", 4_000), ("s4", 1_000))
    ]
    t = {"supplier_positions": table("supplier_positions", book), "markets": table("markets", [dim("m")])}
    (r,) = rows(book_views.v_supplier_concentration(t))
    assert r["top1_supplier"] == "s1" and r["top1_supply_pct"] == 80.0 and r["top3_supply_pct"] == 99.0


def test_price_returns(table):
    t = {
        "prices": table("prices", [price("0xcoll", T0, 68.5), price("0xcoll", T0 + hours(1), 70.0), price("0xcoll", T0 + hours(1.5), 99.0), price("0xcoll", T0 + hours(2), 0.0)]),
        "markets": table("markets", [dim("m")]),
    }
    first, second = rows(price_views.v_price_returns(t), "ts")
    assert first["log_return_1h"] is None and first["symbol"] == "COL"
    assert second["log_return_1h"] == pytest.approx(math.log(70 / 68.5)) and second["vol_7d_ann"] is None


def reference_rate(u, r):
    if u >= 1:
        return 4 * r
    if u >= 0.9:
        return r * (1 + 3 * (u - 0.9) / 0.1)
    return r * (0.25 + 0.75 * u / 0.9) if u > 0 else r / 4


def test_rate_curve_matches_the_closed_form(table):
    levels = [0.0, 0.1, 0.45, 0.8999, 0.9, 0.95, 0.9999, 1.0, 1.2]
    t = {"market_state": table("market_state", [state("m", T0 + hours(i), u) for i, u in enumerate(levels)] + [state("m", T0 - hours(1), None), state("m", T0 - hours(2), 0.5, rate=None)])}
    got = rows(market_views.v_market_apy(t), "ts")
    assert len(got) == len(levels)
    for u, r in zip(levels, got):
        rate = reference_rate(u, 2.6e-9)
        x = rate * u * 31536000
        assert r["borrow_rate_per_sec"] == pytest.approx(rate, rel=1e-12)
        assert r["supply_apy"] == pytest.approx(x + x**2 / 2 + x**3 / 6, rel=1e-12)


def health(table, states, prices=((T0 - hours(24), 1.0),), dims=None):
    t = {
        "market_state": table("market_state", states), "markets": table("markets", dims or [dim("m"), dim("n")]),
        "prices": table("prices", [price("0xloan", ts, usd) for ts, usd in prices]),
    }
    return t, rows(market_views.v_market_health(t), "market_id", "ts")


def rate_for(apy):
    return round(math.log(1 + apy) / 31536000 * 1e18)


def test_ratchet_hysteresis(table):
    apys = [0.21, 0.65, 0.37, 0.21]
    _, got = health(table, [state("m", T0 + hours(i), 0.5, 5 * 10**9, rate_for(a)) for i, a in enumerate(apys)])
    assert [r["is_broken"] for r in got] == [False, True, True, False]
    assert [r["broken_reason"] for r in got] == [None, "rate_ratchet", "rate_ratchet", None]


def test_deep_markets_are_exempt_dust_never(table):
    _, got = health(table, [state("m", T0, 0.5, 10**11, rate_for(0.65)), state("n", T0, 0.5, 5 * 10**8)])
    assert [(r["is_broken"], r["broken_reason"]) for r in got] == [(False, None), (True, "dust")]


def test_unpriced_markets_are_thin_but_not_dust(table):
    _, got = health(table, [state("m", T0, 0.5, 5, rate_for(0.65)), state("n", T0, 0.5, 5)], prices=((T0 + hours(1), 1.0),))
    assert [(r["is_broken"], r["broken_reason"], r["supply_usd"]) for r in got] == [(True, "rate_ratchet", None), (False, None, None)]


def test_pinned_for_a_day_and_calm_for_two(table):
    levels = [0.9995] * 27 + [0.5] * 50
    _, got = health(table, [state("m", T0 + hours(i), u, 5 * 10**9) for i, u in enumerate(levels)])
    broken = [r["is_broken"] for r in got]
    assert (broken[0], broken[21], broken[22], broken[26], broken[47], broken[76]) == (False, False, True, True, True, False)
    assert got[26]["broken_reason"] == "pinned_util"


def test_an_unknown_level_cancels_a_pin(table):
    levels = [0.9995] * 12 + [None] + [0.9995] * 12
    _, got = health(table, [state("m", T0 + hours(i), u, 5 * 10**9) for i, u in enumerate(levels)])
    assert not any(r["is_broken"] for r in got)


def test_spread_and_benchmark(table):
    states = [state("m", T0, 0.8, 10**12), state("n", T0, 0.6, 10**12), state("o", T0, 0.9, 5 * 10**8)]
    t, _ = health(table, states, dims=[dim("m"), dim("n"), dim("o")])
    spread = {r["market_id"]: r for r in rows(market_views.v_apy_spread(t))}
    assert spread["m"]["spread_to_best"] == 0.0 and spread["n"]["spread_to_best"] < 0
    assert spread["o"]["is_broken"] and spread["o"]["spread_to_best"] > 0
    empty = {**t, "bot_scores": table("bot_scores", [])}
    (b,) = rows(market_views.v_benchmark(empty))
    assert (b["markets"], b["investable_markets"], b["bot_markets"], b["bot_best_apy"], b["opportunity_gap_apy"]) == (2, 2, 0, None, None)
    scored = {**t, "bot_scores": table("bot_scores", [{"ts": T0, "market_id": "n", "vault": "v"}, {"ts": T0 + hours(1), "market_id": "n", "vault": "v"}])}
    (b,) = rows(market_views.v_benchmark(scored))
    assert b["bot_markets"] == 1 and b["opportunity_gap_apy"] == pytest.approx(-spread["n"]["spread_to_best"])


def test_no_sound_market_no_spread(table):
    t, _ = health(table, [state("m", T0, 0.5, 5 * 10**8)])
    (r,) = rows(market_views.v_apy_spread(t))
    assert r["is_broken"] and r["spread_to_best"] is None


def test_util_spells(table):
    levels = [0.88, 0.93, 0.96, 0.85]
    t = {"market_state": table("market_state", [state("m", T0 + hours(i), u) for i, u in enumerate(levels)])}
    low, high = rows(spell_views.v_util_spells(t), "threshold")
    assert (low["threshold"], low["duration_min"], low["peak_u"]) == (0.92, 60, 0.96)
    assert (high["threshold"], high["duration_min"]) == (0.95, 0)
    assert low["min_available_liquidity"] == pytest.approx(0.04 * 10**12)


def test_spells_break_on_holes_and_unknown_levels(table):
    at = [(0, 0.99), (2, 0.99), (4.5, 0.99), (5, None), (5.5, 0.99)]
    t = {"market_state": table("market_state", [state("m", T0 + hours(h), u) for h, u in at])}
    got = rows(spell_views.v_util_spells(t).where("threshold = 0.95"), "start_ts")
    assert [r["duration_min"] for r in got] == [120, 0, 0]


TAPE = [
    flow(T0, "Supply", 1, assets=10_000_000_000), flow(T0, "Withdraw", 2, assets=2_000_000_000),
    flow(T0, "Borrow", 3, assets=5_000_000_000), flow(T0, "Repay", 4, assets=1_000_000_000),
    flow(T0, "SupplyCollateral", 5, assets=3 * 10**18),
    flow(T0, "Liquidation", 6, repaid_assets=500_000_000, seized_assets=10**18, bad_debt_assets=100_000_000, liquidator="0xl"),
]


def flow_tables(table):
    return {
        "market_flows": table("market_flows", TAPE), "markets": table("markets", [dim("m")]),
        "prices": table("prices", [price("0xloan", T0 - hours(24), 1.0), price("0xcoll", T0 - hours(24), 2.0)]),
        "market_state": table("market_state", [state("m", T0 - hours(1), 0.5, supply=100_000 * 10**6)]),
    }


def test_flow_signs(table):
    got = {r["type"]: r for r in rows(flow_views.v_market_flows(flow_tables(table)))}
    assert [got[k]["supply_flow"] for k in ("Supply", "Withdraw", "Liquidation")] == [10_000.0, -2_000.0, -100.0]
    assert [got[k]["borrow_flow"] for k in ("Borrow", "Repay", "Liquidation")] == [5_000.0, -1_000.0, -500.0]
    coll = got["SupplyCollateral"]
    assert (coll["collateral_assets"], coll["loan_assets"], coll["supply_flow"], coll["borrow_flow"]) == (3.0, None, None, None)


def test_net_flow_liquidation_and_whales(table):
    t = flow_tables(table)
    (n,) = rows(flow_views.v_market_netflow(t))
    assert (n["supply_in"], n["supply_out"], n["net_supply_flow"]) == (10_000.0, 2_100.0, 7_900.0)
    assert (n["borrow_in"], n["borrow_out"], n["net_borrow_flow"], n["n_events"], n["n_liquidations"]) == (5_000.0, 1_500.0, 3_500.0, 6, 1)
    (liq,) = rows(flow_views.v_liquidations(t))
    assert (liq["repaid_usd"], liq["seized_usd"]) == (500.0, 2.0)
    whales = {r["type"]: r["pct_of_supply"] for r in rows(flow_views.v_whale_flows(t))}
    assert whales == {"Supply": pytest.approx(10.0), "Borrow": pytest.approx(5.0)}


def test_oracle_check_and_depeg_spells(table):
    tape = [2.0, 2.0, 2.2, 2.2, 2.2, 2.0]
    raw = [str(round(p * 10)) + "0" * 23 for p in tape]
    t = {
        "market_state": table("market_state", [state("m", T0 + hours(i), 0.5, oracle_price_raw=p) for i, p in enumerate(raw)] + [state("m", T0 + hours(9), 0.5, oracle_price_raw="junk"), state("m", T0 + hours(10), 0.5)]),
        "markets": table("markets", [dim("m")]),
        "prices": table("prices", [price("0xloan", T0 - hours(24), 1.0), price("0xcoll", T0 - hours(24), 2.0)]),
    }
    got = rows(market_views.v_oracle_price_check(t), "ts")
    assert len(got) == 7 and got[0]["ref_price"] == 2.0 and got[6]["deviation"] is None
    assert [round(r["deviation"], 9) for r in got[:6]] == [0, 0, 0.1, 0.1, 0.1, 0]
    spells = rows(spell_views.v_depeg_spells(t), "threshold")
    assert [(s["threshold"], s["duration_min"]) for s in spells] == [(0.02, 120), (0.05, 120)]
    assert spells[0]["peak_deviation"] == pytest.approx(0.1)
