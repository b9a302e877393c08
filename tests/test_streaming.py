"""Streams against their batch answers."""

import random

from helpers import CHAIN, T0, dim, flow, hours, rows
from pyspark.sql import functions as F

from statelake.plans.flow_views import v_market_netflow
from statelake.sources import Lake
from statelake.streaming import deduplicated, hourly_net_flow, last_in_bucket, online_latch, start_merge
from statelake.streaming.latches import fold
from statelake.tables import MARKET_FLOWS, PRICES


def drop(folder, df, name):
    """One more sealed file in a stream's folder."""
    df.coalesce(1).write.parquet(str(folder / name))


def source(spark, folder, spec):
    return spark.readStream.schema(spec.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def finish(stream, path, mode="append"):
    query = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def test_each_event_once_across_batches_and_restarts(spark, table, tmp_path):
    events = [flow(T0 + hours(h / 4), "Supply", h, assets=10**6) for h in range(8)]
    folder = tmp_path / "in"
    folder.mkdir()
    drop(folder, table("market_flows", events[:5]), "a")
    drop(folder, table("market_flows", events[3:]), "b")  # overlaps the first file
    out = tmp_path / "run"
    finish(deduplicated(source(spark, folder, MARKET_FLOWS)), out)
    drop(folder, table("market_flows", events[5:]), "c")  # a restart delivers known events again
    finish(deduplicated(source(spark, folder, MARKET_FLOWS)), out)
    got = spark.read.parquet(f"{out}/out")
    assert sorted(r["tx_hash"] for r in got.collect()) == sorted(e["tx_hash"] for e in events)


def test_net_flow_of_closed_hours_equals_the_batch_view(spark, table, tmp_path):
    kinds = ["Supply", "Withdraw", "Borrow", "Repay", "Liquidation", "SupplyCollateral"]
    events = [
        flow(T0 + hours(i / 3), kinds[i % 6], i, assets=(i + 1) * 10**6, repaid_assets=i * 10**5, bad_debt_assets=i * 10**4)
        for i in range(24)
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    drop(folder, table("market_flows", events[:12]), "a")
    drop(folder, table("market_flows", events[6:]), "b")
    markets = table("markets", [dim("m")])
    finish(hourly_net_flow(source(spark, folder, MARKET_FLOWS), markets), tmp_path / "run")
    streamed = rows(spark.read.parquet(f"{tmp_path}/run/out"), "ts")
    batch = rows(v_market_netflow({"market_flows": table("market_flows", events), "markets": markets}), "ts")
    last = max(e["ts"] for e in events) - hours(1)
    closed = [r for r in batch if r["ts"] + hours(1) <= last.replace(tzinfo=None)]
    assert streamed == closed and len(closed) >= 5


def test_micro_batches_merge_by_key(spark, table, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    events = [flow(T0 + hours(8 * i), "Supply", i, assets=i) for i in range(6)]
    drop(folder, table("market_flows", events[:4]), "a")
    drop(folder, table("market_flows", events[2:]), "b")
    lake = Lake(spark, str(tmp_path / "lake"))
    for run in ("one", "two"):  # the second checkpoint starts over: everything is replayed
        start_merge(source(spark, folder, MARKET_FLOWS), lake, MARKET_FLOWS, str(tmp_path / run), F.col("block_number")).awaitTermination()
        assert lake.scan(MARKET_FLOWS).count() == 6
    assert lake.scan(MARKET_FLOWS).select("date").distinct().count() == 2


def test_last_sample_of_closed_buckets(spark, table, tmp_path):
    samples = [{"ts": T0 + hours(h), "chain_id": CHAIN, "token_address": "a", "price_usd": p} for h, p in [(0.2, 2.0), (0.1, 1.0), (0.3, 3.0), (5, 9.0)]]
    folder = tmp_path / "in"
    folder.mkdir()
    drop(folder, table("prices", samples), "a")
    stream = source(spark, folder, PRICES).select("chain_id", "token_address", "ts", "price_usd")
    finish(last_in_bucket(stream, ["chain_id", "token_address"], 900), tmp_path / "run")
    got = rows(spark.read.parquet(f"{tmp_path}/run/out"), "ts")
    assert [(r["ts"].minute, r["price_usd"]) for r in got] == [(0, 2.0), (15, 3.0)]


def latch_runs(spark, table, tmp_path, batches, **law):
    """Rows that the latch has shown, batch by batch; a run for each file, so that watermarks pass."""
    folder = tmp_path / "in"
    folder.mkdir()
    event = F.when(F.col("price_usd") > 0.8, 1).when(F.col("price_usd") < 0.2, 0)
    shown = []
    for n, samples in enumerate(batches):
        drop(folder, table("prices", [
            {"ts": T0 + hours(h), "chain_id": i, "token_address": k, "price_usd": v} for i, (k, h, v) in enumerate(samples)]), f"f{n}")
        states = online_latch(source(spark, folder, PRICES), ["token_address"], event, F.col("chain_id"), **law)
        query = (
            states.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
            .foreachBatch(lambda df, _: shown.append(sorted((r.token_address, r.inside, r.held, r.expired) for r in df.collect())))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return [x for x in shown if x]


def test_online_hysteresis_ignores_arrival_order(spark, table, tmp_path):
    batches = [[("a", 3, 0.9)], [("a", 2.5, 0.1), ("b", 2.9, 0.9), ("b", 3, 0.5), ("c", 3, 0.5)], [("a", 3, 0.1), ("a", 3, 0.5)]]
    shown = latch_runs(spark, table, tmp_path, batches)
    # Of one instant the later place decides; an entity whose state stays is not shown.
    assert shown == [[("a", True, False, False)], [("b", True, False, False), ("c", False, False, False)]]


def test_latch_timers(spark, table, tmp_path):
    batches = [
        [("a", 1, 0.9), ("b", 1, 0.9), ("b", 2, 0.1), ("z", 2, 0.5)], [("z", 5.5, 0.5)],
        # Late, but within the lateness: the spell began anew at 5.
        [("a", 4.8, 0.1), ("a", 5, 0.9), ("z", 9, 0.5)], [("z", 30, 0.5)], [("z", 31, 0.5)],
    ]
    shown = latch_runs(spark, table, tmp_path, batches, dwell_seconds=3 * 3600, expiry_seconds=12 * 3600)
    assert shown[0] == [("a", True, False, False), ("b", False, False, False), ("z", False, False, False)]
    changes = [x for batch in shown[1:] for x in batch]
    assert changes == [("a", True, True, False), ("a", True, False, False), ("a", True, True, False), ("a", False, False, True), ("b", False, False, True)]


def test_fold_is_the_state_after_all_events():
    rnd = random.Random(5)
    for _ in range(300):
        events = [(rnd.randrange(20), rnd.randrange(3), rnd.randrange(2)) for _ in range(rnd.randrange(12))]
        inside, since = False, None
        for at, _tie, event in sorted(events):
            since = (since if inside else at) if event else None
            inside = bool(event)
        shuffled = rnd.sample(events, len(events))
        assert fold(False, None, shuffled) == (inside, since)
        border = rnd.randrange(20)
        early, late = [e for e in events if e[0] <= border], [e for e in events if e[0] > border]
        assert fold(*fold(False, None, early), late) == (inside, since)
