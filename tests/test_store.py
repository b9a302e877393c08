"""Keyed merges, log files, snapshots, reader, quality report."""

import json
from decimal import Decimal

import pytest
from helpers import CHAIN, T0, dim, hours, price, rows, state
from pyspark.sql import functions as F

from statelake.operators import heal_candidates
from statelake.plans import quality
from statelake.plans.reader import Reader
from statelake.sources import Lake, coerce, event_rows, legacy_rows, read_log, read_snapshots, resume_from, score_rows, split_lines
from statelake.streaming import ingest_logs
from statelake.tables import BOT_EVENTS, BOT_SCORES, MARKET_FLOWS, MARKET_STATE, MARKETS, PRICES

BIG = 31415926535897932384626433832


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_upsert_is_idempotent_and_later_rows_win(lake, table):
    batch = table("prices", [price("a", T0, 1.0), price("b", T0, 2.0)])
    assert lake.upsert(PRICES, batch) == 2 and lake.upsert(PRICES, batch) == 2
    assert lake.scan(PRICES).count() == 2
    later = table("prices", [price("a", T0, 5.0), price("a", T0, 7.0), price("b", T0 + hours(30), 3.0)])
    assert lake.upsert(PRICES, later) == 3
    got = rows(lake.scan(PRICES), "token_address", "ts")
    assert [(r["token_address"], r["price_usd"]) for r in got] == [("a", 7.0), ("b", 2.0), ("b", 3.0)]


def test_exact_integers_survive(lake, table):
    for shift in (1, 10**6):
        lake.upsert(MARKET_STATE, table("market_state", [state("m", T0, 0.5, supply=BIG * shift)]))
        assert lake.scan(MARKET_STATE).first()["total_supply_assets"] == Decimal(BIG * shift)


def test_rows_go_to_their_utc_day(lake, table, tmp_path):
    lake.upsert(PRICES, table("prices", [price("a", T0 + hours(23), 1.0), price("a", T0 + hours(24), 2.0)]))
    days = sorted(p.name for p in (tmp_path / "lake" / "prices").glob("date=*"))
    assert days == ["date=2026-03-02", "date=2026-03-03"]
    plan = lake.scan(PRICES).where("date = date '2026-03-03'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_untouched_days_are_not_rewritten(lake, table, tmp_path):
    lake.upsert(PRICES, table("prices", [price("a", T0, 1.0), price("a", T0 + hours(24), 2.0)]))
    day = tmp_path / "lake" / "prices" / "date=2026-03-02"
    before = sorted((p.name, p.stat().st_mtime_ns) for p in day.rglob("*.parquet"))
    lake.upsert(PRICES, table("prices", [price("a", T0 + hours(25), 3.0)]))
    assert sorted((p.name, p.stat().st_mtime_ns) for p in day.rglob("*.parquet")) == before


def test_insert_missing_never_changes_a_row(lake, table):
    live = [state("m", T0 + hours(h), 0.5, oracle_price_raw="1") for h in (8, 11)]
    lake.upsert(MARKET_STATE, table("market_state", live))
    history = table("market_state", [state("m", T0 + hours(h), 0.9, source="backfill") for h in (8, 9, 10, 11)])
    fill = heal_candidates(history, F.lit(T0 + hours(12)).cast("timestamp"), 24)
    assert lake.insert_missing(MARKET_STATE, fill) == 2
    assert lake.insert_missing(MARKET_STATE, fill) == 0
    got = rows(lake.scan(MARKET_STATE), "ts")
    assert [r["source"] for r in got] == ["live", "backfill", "backfill", "live"]
    assert [r["oracle_price_raw"] for r in got] == ["1", None, None, "1"]


def test_null_key_rejects_the_whole_batch(lake, table):
    lake.upsert(PRICES, table("prices", [price("a", T0, 1.0)]))
    bad = table("prices", [price("b", T0, 1.0), price("c", None, 1.0)])
    with pytest.raises(ValueError, match="null in key column"):
        lake.upsert(PRICES, bad)
    with pytest.raises(ValueError, match="null in key column"):
        lake.insert_missing(PRICES, bad)
    assert lake.scan(PRICES).count() == 1


def test_dimension_is_overwritten_by_key(lake, table):
    lake.upsert(MARKETS, table("markets", [dim("a"), dim("b")]))
    lake.upsert(MARKETS, table("markets", [dim("b", loan_symbol="NEW"), dim("c")]))
    got = rows(lake.scan(MARKETS), "market_id")
    assert [(r["market_id"], r["loan_symbol"]) for r in got] == [("a", "USD"), ("b", "NEW"), ("c", "USD")]
    assert "slot" not in lake.scan(MARKETS).columns


def test_absent_tables_are_empty_not_errors(lake):
    assert not lake.has_data(PRICES) and lake.available() == [] and lake.scan(PRICES).count() == 0
    assert lake.upsert(PRICES, lake.scan(PRICES)) == 0


def test_coercion_fills_drops_and_overflows_loudly(spark):
    df = spark.createDataFrame([(T0, "7", "x")], "ts timestamp, chain_id string, other string")
    out = coerce(df, PRICES)
    assert out.columns == PRICES.columns and out.first()["chain_id"] == 7
    huge = spark.createDataFrame([(T0, "9" * 39)], "ts timestamp, total_supply_assets string")
    with pytest.raises(Exception, match="more than 38 digits"):
        coerce(huge, MARKET_STATE).collect()


def test_resume_overlaps_by_one_hour(spark, table):
    stored = table("market_flows", [{"ts": T0 + hours(5), "chain_id": CHAIN, "tx_hash": "a", "log_index": 1}])
    new = table("market_flows", [{"ts": T0 + hours(h), "chain_id": c, "tx_hash": str(h), "log_index": 1} for h, c in ((3.9, CHAIN), (4, CHAIN), (6, CHAIN), (1, 1), (9, 1))])
    got = rows(resume_from(new, stored, first_since=(T0 + hours(2)).isoformat()), "ts")
    assert [r["tx_hash"] for r in got] == ["4", "6", "9"]


def log_text(partial: bool) -> str:
    tick = {"ts": "2025-11-03T04:17:31.250Z", "bot": "b", "chainId": 7, "tickId": "t1"}
    score = {"marketId": "m1", "u": 0.5, "vaultAssets": "770011"}
    lines = [
        json.dumps({**tick, "type": "tick_start"}),
        json.dumps({**tick, "type": "scores", "vault": "0xAbC", "totalAssets": "20", "scores": [score, {**score, "marketId": "m2"}]}),
        "not json",
        json.dumps({**tick, "type": "unheard_of"}),
        json.dumps({**tick, "type": "tx_confirmed", "txHash": "0x9", "tx": {"gas": 1, "blockNumber": "123"}, "b": True, "a": {"y": 1, "x": "ü"}}),
    ]
    return "\n".join(lines) + "\n" + ('{"ts":"2025-11-03T04:17:3' if partial else "")


def check_log(split):
    assert split.where("not ok").count() == 2
    events = rows(event_rows(split), "seq")
    assert [(r["seq"], r["type"]) for r in events] == [(0, "tick_start"), (4, "tx_confirmed")]
    assert events[0]["payload"] is None and events[0]["block_number"] is None
    assert events[1]["block_number"] == 123 and events[1]["tx_hash"] == "0x9"
    payload = json.loads(events[1]["payload"])
    assert payload == {"a": {"x": "ü", "y": 1}, "b": True, "tx": {"blockNumber": "123", "gas": 1}} and list(payload) == ["a", "b", "tx"]
    scores = rows(score_rows(split), "market_id")
    assert [r["market_id"] for r in scores] == ["m1", "m2"]
    assert scores[0]["vault"] == "0xAbC" and scores[0]["ts"].second == 0 and scores[0]["vault_assets"] == 770011


def test_log_waits_for_complete_lines(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "events-2026-07-20.jsonl").write_text(log_text(partial=True))
    (folder / "other.txt").write_text("ignored\n")
    lines = read_log(spark, str(folder))
    assert lines.count() == 5
    check_log(split_lines(lines))
    (folder / "events-2026-07-20.jsonl").write_text(log_text(partial=False))
    assert read_log(spark, str(folder)).count() == 5


def test_log_line_numbers_across_blocks(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "events-a.jsonl").write_text("".join(f"line {i} {'x' * (i % 50)}\n" for i in range(3000)) + "tail")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = read_log(spark, str(folder))
        assert lines.rdd.getNumPartitions() > 1
        got = {r["seq"]: r["line"].split()[1] for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: str(i) for i in range(3000)}


def test_sealed_logs_as_a_stream(spark, tmp_path, lake):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "events-2026-07-20.jsonl").write_text(log_text(partial=False))
    for n in (1, 2):
        ingest_logs(spark, str(folder), lake, str(tmp_path / "bad"), str(tmp_path / f"cp{n}")).awaitTermination()
    assert lake.scan(BOT_EVENTS).count() == 2 and lake.scan(BOT_SCORES).count() == 2
    assert spark.read.json(str(tmp_path / "bad")).count() == 2


def test_snapshot_folder(spark, tmp_path):
    market = {"symbol": "A/B", "marketId": "m", "loan": "0xLOAN", "collateral": "", "utilisation": 0.5, "borrowAPY": 0.1, "supplyAPY": 0.05, "availableLiquidity": 9.5, "vaultAllocation": 1}
    doc = {"timestamp": "2025-11-02T06:00:00.000Z", "chainId": 7, "markets": [market, {**market, "marketId": "n", "utilisation": None, "utilization": 0.7}]}
    (tmp_path / "snapshot-2025-11-02.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "snapshot-2025-11-03.json").write_text("{ broken")
    (tmp_path / "unrelated.json").write_text(json.dumps(doc))
    got = rows(legacy_rows(read_snapshots(spark, str(tmp_path))), "market_id")
    assert [(r["market_id"], r["utilization"], r["collateral_token"], r["loan_token"]) for r in got] == [("m", 0.5, None, "0xloan"), ("n", 0.7, None, "0xloan")]
    assert got[0]["source_file"] == "snapshot-2025-11-02.json" and got[0]["ts"].hour == 6


def test_reader(lake, table, spark):
    lake.upsert(MARKET_STATE, table("market_state", [state("m", T0 + hours(24 * d), 0.5) for d in range(4)] + [state("n", T0, 0.9)]))
    lake.upsert(MARKETS, table("markets", [dim("m"), dim("n", "OTHER")]))
    reader = Reader(spark, lake.root)
    assert "v_market_state" in reader.tables() and "v_market_health" not in reader.tables()
    since = (T0 + hours(48)).strftime("%Y-%m-%d %H:%M:%S")
    df = reader.market_state(loan="USD", collateral="COL", since=since)
    assert df.count() == 2
    assert "date" in df._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r["market_id"] for r in reader.market_state_latest().collect()) == ["m", "n"]
    assert reader.sql("SELECT count(*) AS n FROM v_market_state WHERE utilization > ?", [0.8]).first()["n"] == 1
    lake.upsert(PRICES, table("prices", [price("0xloan", T0, 1.0)]))
    reader.refresh()
    assert "v_market_health" in reader.tables() and reader.prices(symbol="USD").count() == 1


def test_gap_report_has_no_phantom_gap(table):
    fine = table("market_state", [state("m", T0 + hours(h), 0.5) for h in (10, 11, 11.8)])
    assert quality.bucket_gaps(fine, ["chain_id", "market_id"], 3600).count() == 0
    holes = table("market_state", [state("m", T0 + hours(h), 0.5) for h in (10, 13)])
    (g,) = rows(quality.bucket_gaps(holes, ["chain_id", "market_id"], 3600))
    assert (g["expected"], g["actual"]) == (4, 2)
    assert [r["ts"].hour for r in rows(quality.missing_buckets(holes, ["chain_id", "market_id"], 3600), "ts")] == [11, 12]
    text = quality.report({"market_state": holes})
    assert "2 of 4 buckets" in text and "market_state: 2 rows" in text and "| oracle_price_raw | 100.00 |" in text and "in 1 entities" in text


def test_null_rates(table):
    df = table("prices", [price("a", T0, 1.0, confidence=0.5), price("b", T0, None)])
    got = {r["column_name"]: r["null_rate"] for r in rows(quality.null_rates(df))}
    assert got == {"price_usd": 0.5, "confidence": 0.5}


def test_gap_report_keeps_only_the_first_rows(table):
    T = T0.replace(hour=0, minute=0)
    holes = table("market_state", [state(f"m{i:02d}", T + hours(h), 0.5) for i in range(40) for h in (0, 2 + i % 20)])
    total, first = quality.largest(quality.bucket_gaps(holes, ["chain_id", "market_id"], 3600), ["chain_id", "market_id"])
    assert (total, len(first)) == (40, quality.REPORT_ROWS)
    assert [r["market_id"] for r in first][:4] == ["m19", "m39", "m18", "m38"]
    text = quality.report({"market_state": holes})
    assert "in 40 entities" in text and f"and {40 - quality.REPORT_ROWS} others" in text and text.count("\n* ") == quality.REPORT_ROWS + 1
