"""Documents read back line by line, by several tasks."""

import json

import pytest
from helpers import CHAIN, T0, dim, flow, hours
from pyspark.sql import functions as F

from statelake.plans.export import run_export
from workload.document_queries import FLOW_HEADER_KIND, FLOW_LISTS, elements_of

NOW = T0 + hours(30)


@pytest.fixture()
def tables(table):
    kinds = ["Supply", "Withdraw", "Borrow", "Repay"]
    flows = [flow(T0 + hours(i % 29), kinds[i % 4], i, f"m{i % 40}", assets=10**9 + i) for i in range(200)]
    return {"market_flows": table("market_flows", flows), "markets": table("markets", [dim(f"m{i}", "K") for i in range(40)])}


@pytest.mark.parametrize("most", ["700", "5000", "100m"])
def test_elements_in_their_order(spark, tables, tmp_path, most):
    run_export(spark, tables, str(tmp_path), NOW, only=["market_flows.json"])
    path = tmp_path / "market_flows.json"
    document = json.loads(path.read_text())
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = {name: elements_of(spark, str(path), FLOW_HEADER_KIND, name, kind) for name, kind in FLOW_LISTS.items()}
        found = {name: df.orderBy("place").select("schema_version", "generated_at", "chain_id", "data_through", "synced", "place", F.to_json("e", {"ignoreNullFields": "false"})).collect() for name, df in read.items()}
        assert most == "100m" or spark.read.text(str(path)).rdd.getNumPartitions() > 1
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    header = tuple(document[k] for k in ("schema_version", "generated_at", "chain_id", "data_through", "synced"))
    assert len(found["markets"]) == 40 and header[2] == CHAIN
    for name, rows in found.items():
        assert [tuple(r[:5]) for r in rows] == [header] * len(document[name])
        assert [r[5] for r in rows] == list(range(1, len(document[name]) + 1))
        assert [json.loads(r[6]) for r in rows] == document[name]
