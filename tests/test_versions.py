"""Published versions of stored tables, newest instants, batches that are delivered twice."""

import pytest
from helpers import CHAIN, T0, dim, flow, hours, price, rows, state
from pyspark.sql import functions as F

from statelake.plans import book_views, market_views, vault_views
from statelake.plans.reader import Reader
from statelake.sources import Lake, resume_from
from statelake.sources.versions import Conflict, Versions
from statelake.streaming import keyed_merge
from statelake.tables import MARKET_FLOWS, MARKET_STATE, MARKETS, POSITIONS, PRICES, SUPPLIER_POSITIONS, VAULT_ALLOCATIONS


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def seen(lake, spec=PRICES):
    return [(r["token_address"], r["price_usd"]) for r in rows(lake.scan(spec), "token_address", "ts")]


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "days_of", "with_newest", "publish", "rename"])
@pytest.mark.parametrize("merge", ["upsert", "insert_missing"])
def test_a_merge_killed_at_any_step_leaves_the_old_state(lake, table, monkeypatch, step, merge):
    lake.upsert(PRICES, table("prices", [price("a", T0, 1.0), price("b", T0 + hours(30), 2.0)]))
    old = seen(lake)
    batch = table("prices", [price("a", T0, 5.0), price("c", T0, 6.0), price("c", T0 + hours(40), 7.0)])

    def die(*_args, **_kw):
        raise Killed

    where = {
        "write": (type(batch), "sortWithinPartitions"), "days_of": (Versions, "days_of"), "with_newest": (Lake, "_with_newest"),
        "publish": (Versions, "publish"), "rename": (Versions, "_rename"),
    }[step]
    with monkeypatch.context() as patched:
        patched.setattr(*where, die)
        with pytest.raises(Killed):
            getattr(lake, merge)(PRICES, batch)
    assert seen(lake) == old
    assert getattr(lake, merge)(PRICES, batch) == (3 if merge == "upsert" else 2)
    assert seen(lake) == [("a", 5.0 if merge == "upsert" else 1.0), ("b", 2.0), ("c", 6.0), ("c", 7.0)]
    # What the killed merge has left is nobody's.
    lake.prune(PRICES)
    assert len(seen(lake)) == 4 and lake.prune(PRICES) == 0


def test_of_two_writers_one_publishes(lake, table, monkeypatch):
    lake.upsert(PRICES, table("prices", [price("a", T0, 1.0)]))
    stale = lake.versions(PRICES).current()
    lake.upsert(PRICES, table("prices", [price("a", T0, 2.0)]))
    with monkeypatch.context() as patched:
        patched.setattr(Versions, "current", lambda self: stale)
        with pytest.raises(Conflict):
            lake.upsert(PRICES, table("prices", [price("a", T0, 3.0)]))
    assert seen(lake) == [("a", 2.0)]
    lake.upsert(PRICES, table("prices", [price("a", T0, 3.0)]))
    assert seen(lake) == [("a", 3.0)]


def test_a_reader_keeps_its_version_until_it_is_pruned(lake, table):
    for n in range(3):
        lake.upsert(PRICES, table("prices", [price("a", T0, float(n)), price("a", T0 + hours(24 * n), float(n))]))
    old = lake.scan(PRICES, lake.versions(PRICES).read(1))
    assert [r["price_usd"] for r in rows(old)] == [0.0]
    assert lake.prune(PRICES, keep=2) > 0 and lake.versions(PRICES).numbers() == [2, 3]
    assert seen(lake) == [("a", 2.0), ("a", 1.0), ("a", 2.0)]
    assert rows(lake.newest(PRICES))[0]["ts"] == (T0 + hours(48)).replace(tzinfo=None)


def test_a_batch_is_merged_once(lake, table):
    merge = keyed_merge(lake, MARKET_FLOWS, F.col("block_number"), "here")
    first = table("market_flows", [{**flow(T0, "Supply", 1), "block_number": n} for n in (3, 9, 5)])
    merge(first, 0)
    merge(table("market_flows", [{**flow(T0, "Supply", 1), "block_number": 99}]), 0)
    (r,) = rows(lake.scan(MARKET_FLOWS))
    assert r["block_number"] == 9
    merge(table("market_flows", [flow(T0, "Supply", 2)]), 1)
    keyed_merge(lake, MARKET_FLOWS, F.col("block_number"), "there")(table("market_flows", [flow(T0, "Supply", 3)]), 0)
    assert lake.scan(MARKET_FLOWS).count() == 3
    assert lake.versions(MARKET_FLOWS).current().merged == {"here": 1, "there": 0}


def test_newest_snapshots_read_their_days_only(lake, table, spark):
    def holder(kind, market, day, amount, name):
        if kind == "positions":
            return {"ts": T0 + hours(24 * day), "chain_id": CHAIN, "market_id": market, "borrower": name, "borrow_assets": amount, "health_factor": 1.01}
        return {"ts": T0 + hours(24 * day), "chain_id": CHAIN, "market_id": market, "supplier": name, "supply_assets": amount}

    for kind, spec in (("positions", POSITIONS), ("supplier_positions", SUPPLIER_POSITIONS)):
        # One market has stopped early; the others' newest snapshot is of the last day.
        for day in range(6):
            lake.upsert(spec, table(kind, [holder(kind, m, day, 10 * i + day, f"h{i}") for m in ("m", "n") for i in range(4) if m == "m" or day < 2]))
    lake.upsert(MARKETS, table("markets", [dim("m"), dim("n")]))
    lake.upsert(VAULT_ALLOCATIONS, table("vault_allocations", [{"ts": T0 + hours(24 * d), "chain_id": CHAIN, "vault": "v", "market_id": "m", "supply_assets": d} for d in range(4)]))
    lake.upsert(MARKET_STATE, table("market_state", [state("m", T0 + hours(24 * d), 0.5) for d in range(4)]))
    t = lake.tables()
    plain = dict(t)
    for view in (book_views.v_position_risk, book_views.v_supplier_concentration, vault_views.v_vault_snapshot, market_views.v_market_snapshot):
        assert rows(view(t), "ts") == rows(view(plain), "ts")
        plan = view(t)._jdf.queryExecution().executedPlan().toString()
        filters = [x.split("PartitionFilters: [")[1].split("],")[0] for x in plan.splitlines() if "PartitionFilters: [" in x]
        assert any("date" in f and "IN" in f.upper() or "date" in f and "=" in f for f in filters), filters
    assert t.newest["positions"][1] == ["2026-03-03", "2026-03-07"]
    assert [r["n"] for r in rows(Reader(spark, lake.root).sql("SELECT count(*) AS n FROM v_position_risk"))] == [2]
    assert [r["ts"].day for r in rows(Reader(spark, lake.root).market_state_latest())] == [5]


def test_resume_from_newest_instants(lake, table):
    events = [{**flow(T0 + hours(h), "Supply", i), "chain_id": c} for i, (h, c) in enumerate([(1, 1), (30, 1), (2, 2), (90, 2)])]
    for e in events:
        lake.upsert(MARKET_FLOWS, table("market_flows", [e]))
    new = table("market_flows", [{**flow(T0 + hours(h), "Supply", 50 + i), "chain_id": c} for i, (h, c) in enumerate([(28, 1), (29, 1), (80, 2), (95, 2), (1, 3)])])
    fast, slow = (rows(resume_from(new, stored), "tx_hash") for stored in (lake.newest(MARKET_FLOWS), lake.scan(MARKET_FLOWS)))
    assert fast == slow and [r["tx_hash"] for r in fast] == ["0x51", "0x53", "0x54"]
    read = resume_from(new, lake.newest(MARKET_FLOWS)).inputFiles()
    assert read and all("/_newest/" in f for f in read)
