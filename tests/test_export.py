"""Documents: contents, order, files."""

import json
from datetime import timedelta

import pytest
from helpers import CHAIN, T0, dim, flow, hours, price, state

from statelake.plans.export import flow_summary, run_export
from statelake.sources import Lake
from statelake.tables import MARKET_FLOWS, MARKETS

HIGH = 16_000_000_000
NOW = T0 + hours(30)


@pytest.fixture()
def tables(table):
    states = [state("good", T0 + hours(h), 0.8) for h in range(30)]
    states += [state("ratchet", T0 + hours(h), 0.5, 5 * 10**9, HIGH) for h in range(30)]
    states += [state("pin", T0 + hours(h), 0.9995, 5 * 10**9) for h in range(30)]
    states += [state("dust", T0 + hours(29), 0.5, 5 * 10**8), state("stale", T0 - hours(60), 0.5)]
    book = [
        {"ts": T0 + hours(29), "chain_id": CHAIN, "market_id": "good", "borrower": f"b{i}", "borrow_assets": a, "health_factor": hf}
        for i, (a, hf) in enumerate([(700_000, 1.02), (200_000, 1.6), (100_000, 2.5)])
    ]
    return {
        "market_state": table("market_state", states),
        "markets": table("markets", [dim("good", "K"), dim("ratchet", "W"), dim("pin", "U"), dim("dust", None), dim("stale")]),
        "prices": table("prices", [price("0xloan", T0 - hours(90), 1.0)]),
        "positions": table("positions", book),
    }


def load(folder, name):
    return json.loads((folder / name).read_text())


def test_documents_without_flows(spark, tables, tmp_path):
    written = run_export(spark, tables, str(tmp_path), NOW)
    assert written == ["market_health.json", "util_spells.json", "depeg_spells.json"]
    assert not list(tmp_path.glob("*.staging"))
    doc = load(tmp_path, "market_health.json")
    assert (doc["schema_version"], doc["chain_id"], doc["generated_at"]) == (3, CHAIN, "2026-03-03T06:00:00Z")
    ids = [m["market_id"] for m in doc["markets"]]
    assert ids[0] == "good" and sorted(ids) == ["dust", "good", "pin", "ratchet"]
    by_id = {m["market_id"]: m for m in doc["markets"]}
    good = by_id["good"]
    assert good["is_broken"] is False and good["broken_reason"] is None and good["spread_to_best"] == 0.0
    assert good["borrower_risk"] == {
        "borrowers": 3, "min_hf": 1.02, "borrowers_hf_lt_105": 1, "pct_debt_hf_lt_105": 0.7, "top3_debt_pct": 1.0,
    }
    assert good["supplier_concentration"] is None and by_id["pin"]["borrower_risk"] is None
    assert len(good["history"]) == 30 and good["history"][0]["ts"] == "2026-03-02T00:00:00Z"
    assert good["utilization_regime"]["avg_util_7d"] == pytest.approx(0.8)
    assert {k: by_id[k]["broken_reason"] for k in ("ratchet", "pin", "dust")} == {"ratchet": "rate_ratchet", "pin": "pinned_util", "dust": "dust"}
    assert by_id["dust"]["collateral_symbol"] is None

    spells = load(tmp_path, "util_spells.json")["spells"]
    assert {(s["market_id"], s["threshold"], s["open"]) for s in spells} == {("pin", 0.92, True), ("pin", 0.95, True)}
    empty = load(tmp_path, "depeg_spells.json")
    assert empty["spells"] == [] and empty["chain_id"] is None


def test_flow_document(spark, tables, table, tmp_path):
    tape = [
        flow(NOW - hours(1), "Supply", 1, "good", assets=10**11), flow(NOW - hours(50), "Withdraw", 2, "good", assets=10**9),
        flow(NOW - hours(2), "Liquidation", 3, "good", repaid_assets=10**6, seized_assets=10**18, bad_debt_assets=0),
    ]
    tables = {**tables, "market_flows": table("market_flows", tape)}
    assert "market_flows.json" in run_export(spark, tables, str(tmp_path), NOW)
    doc = load(tmp_path, "market_flows.json")
    assert doc["synced"] is True and doc["data_through"] == "2026-03-03T05:00:00Z"
    (m,) = doc["markets"]
    assert (m["supply_in_24h"], m["net_supply_24h"], m["supply_out_7d"], m["n_liquidations_30d"]) == (100_000.0, 100_000.0, 1_000.0, 1)
    assert len(m["flow_history"]) == 3
    assert [w["flow"] for w in doc["whale_flows"]] == [100_000.0]
    assert [x["repaid_usd"] for x in doc["liquidations"]] == [1.0] and doc["liquidations"][0]["seized_usd"] is None
    # Written again later: replaced, and no longer in sync.
    run_export(spark, tables, str(tmp_path), NOW + timedelta(hours=3))
    assert load(tmp_path, "market_flows.json")["synced"] is False


def test_empty_tape_is_not_synced(spark, tables, table, tmp_path):
    run_export(spark, {**tables, "market_flows": table("market_flows", [])}, str(tmp_path), NOW)
    doc = load(tmp_path, "market_flows.json")
    assert (doc["synced"], doc["data_through"], doc["markets"], doc["whale_flows"]) == (False, None, [], [])


def test_documents_are_skipped_when_their_tables_are_absent(spark, tables, tmp_path):
    assert run_export(spark, {"market_state": tables["market_state"]}, str(tmp_path), NOW) == ["util_spells.json"]


def test_feeds_skip_days_before_their_look_back(spark, table, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    tape = [flow(NOW - hours(h), "Supply", h, "good", assets=10**9) for h in (0, 24, 24 * 40, 24 * 90)]
    lake.upsert(MARKET_FLOWS, table("market_flows", tape))
    lake.upsert(MARKETS, table("markets", [dim("good")]))
    df = flow_summary(lake.tables())
    (r,) = df.collect()
    assert (r["supply_in_24h"], r["supply_in_7d"]) == (2_000.0, 2_000.0)
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_documents_are_written_by_several_tasks(spark, tables, tmp_path):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    whole, joined, parts = (tmp_path / n for n in ("whole", "joined", "parts"))
    run_export(spark, tables, str(whole), NOW)
    try:
        for k, v in zip(old, ("5", "false"), strict=True):
            spark.conf.set(k, v)
        run_export(spark, tables, str(joined), NOW)
        assert run_export(spark, tables, str(parts), NOW, only=["market_health.json"], joined=False) == ["market_health.json"]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name in ("market_health.json", "util_spells.json", "depeg_spells.json"):
        assert (whole / name).read_bytes() == (joined / name).read_bytes()
    folder = parts / "market_health.json.parts"
    listed = json.loads((folder / "_parts.json").read_text())
    assert len(listed) > 1 and [x["bytes"] for x in listed] == [(folder / x["name"]).stat().st_size for x in listed]
    assert b"".join((folder / x["name"]).read_bytes() for x in listed) == (whole / "market_health.json").read_bytes()
