"""Views and readers over tables that were merged into a lake first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.operators.coverage import gaps, holes
from statelake.plans import book_views, market_views, quality, vault_views
from statelake.plans.reader import Reader
from statelake.sources import Lake, resume_from
from statelake.sources.covered import cover, coverage_table
from statelake.tables import MARKET_FLOWS, TABLES

from .adapters import Given
from .operator_queries import OPERATOR_QUERIES, fresh_lake
from .spec import Query
from .view_queries import VIEW_QUERIES

_TWINS = {q.name: q for q in [*VIEW_QUERIES, *OPERATOR_QUERIES]}


def stored(g: Given, *names: str) -> Lake:
    """The tables merged in two batches, the second of which has the newer half again and what the first lacks."""
    lake = fresh_lake(g)
    for name in names:
        spec, df = TABLES[name], g.table(name)
        if not spec.partitioned:
            lake.upsert(spec, df)
            continue
        middle = df.agg(F.timestamp_seconds((F.unix_timestamp(F.min("ts")) + F.unix_timestamp(F.max("ts"))) / 2).alias("ts"))
        lake.upsert(spec, df.where(F.col("ts") < middle.scalar()), F.col("ts"))
        lake.insert_missing(spec, df, F.col("ts"))
    return lake


def _like(name: str, twin: str, run) -> Query:
    """A query with the answer of another one."""
    return Query(name, run, _TWINS[twin].sql, _TWINS[twin].digits, _TWINS[twin].exact)


def resumed(g: Given) -> DataFrame:
    """Resumed from the newest instants that the stored table names."""
    lake, flows = fresh_lake(g), g.table("market_flows")
    lake.upsert(MARKET_FLOWS, flows.where("ts < timestamp '2024-01-15 00:00:00' and chain_id <> 3"), F.col("block_number"))
    return resume_from(flows, lake.newest(MARKET_FLOWS), first_since="2024-01-25 00:00:00").select("tx_hash", "log_index", "ts", "chain_id")


def covered(g: Given, name: str, entity: list[str]) -> DataFrame:
    """Coverage of a table whose rows came in three batches, the last of which repeats some."""
    lake, spec, df = fresh_lake(g), TABLES[name], g.table(name)
    for condition in ("day(ts) < 12", "day(ts) >= 20", "day(ts) >= 10 and day(ts) < 22"):
        cover(lake, spec, df.where(condition), entity, 3600)
    return lake.scan(coverage_table(spec, entity))


STORED_QUERIES = [
    _like("quality_gaps_merged", "quality_gaps",
          lambda g: quality.day_names(gaps(covered(g, "market_state", ["chain_id", "market_id"]), ["chain_id", "market_id"], 3600))),
    _like("quality_missing_merged", "quality_missing_buckets",
          lambda g: holes(covered(g, "prices", ["chain_id", "token_address"]), ["chain_id", "token_address"], 3600)),
    _like("stored_position_risk", "v_position_risk", lambda g: book_views.v_position_risk(stored(g, "positions", "markets").tables())),
    _like("stored_supplier_concentration", "v_supplier_concentration",
          lambda g: book_views.v_supplier_concentration(stored(g, "supplier_positions", "markets").tables())),
    _like("stored_vault_snapshot", "v_vault_snapshot", lambda g: vault_views.v_vault_snapshot(stored(g, "vault_allocations", "markets").tables())),
    _like("stored_market_snapshot", "v_market_snapshot", lambda g: market_views.v_market_snapshot(stored(g, "market_state", "markets").tables())),
    _like("stored_read_since", "read_market_state",
          lambda g: Reader(g.spark, stored(g, "market_state", "markets").root).market_state(loan="SYM1", collateral="COL5", since="2024-01-10 00:00:00")),
    _like("stored_resume_from", "resume_from_stored", resumed),
]
