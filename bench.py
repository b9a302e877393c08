"""Headline queries at one scale; prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per query after one warm-up (default 3)

The number of a query is the median of its timed runs, planning included; the
value is their sum. ``duckdb`` holds the same for the SQL twin, where the module
is installed, as a yardstick.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "v_liquidity_risk", "v_market_snapshot", "v_position_risk", "v_vault_drift", "v_price_returns", "v_market_apy",
    "v_market_health", "v_apy_spread", "v_benchmark", "v_util_spells", "v_market_netflow", "v_liquidations",
    "v_whale_flows", "v_oracle_price_check", "v_depeg_spells", "asof_join", "store_upsert", "payload_market_state_history",
    "payload_bot_events", "quality_gaps", "export_flow_summary", "export_latest_panel",
]


def timed(run, repeats: int) -> float:
    run()
    taken = []
    for _ in range(repeats):
        began = time.perf_counter()
        run()
        taken.append(time.perf_counter() - began)
    return round(statistics.median(taken), 3)


def main() -> None:
    from statelake.session import local_session
    from workload.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="statelake-bench")
    try:
        from workload.compare import connect

        con = connect(sf_dir)
    except ImportError:
        con = None

    seconds, yardstick = {}, {}
    for name in HEADLINE:
        query = QUERIES[name]
        seconds[name] = timed(lambda: query.spark(spark, sf_dir).write.format("noop").mode("overwrite").save(), repeats)
        if con is not None and query.sql is not None:
            yardstick[name] = timed(lambda: con.execute(query.oracle()).fetchall(), repeats)
        print(f"{name} {seconds[name]} {yardstick.get(name)}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "duckdb": yardstick,
    }))


if __name__ == "__main__":
    main()
