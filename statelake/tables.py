"""The thirteen stored tables: schema, identity and partitioning.

Amounts are exact base-unit integers, DECIMAL(38,0); derived metrics are doubles
computed at query time. ``key`` is the identity a merge works on, ``entity`` what
a sample or event is of: a table's newest instants are kept per entity.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    key: tuple[str, ...]
    entity: tuple[str, ...] = ()
    partitioned: bool = True  # one partition per UTC day of ``ts``
    schema: T.StructType = field(init=False, compare=False)

    def __post_init__(self) -> None:
        parsed = []
        for part in self.ddl.split(","):
            name, kind = part.split()
            parsed.append(T.StructField(name, _TYPES[kind]))
        object.__setattr__(self, "schema", T.StructType(parsed))

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def guard_column(self) -> str:
        """The column that may never be NULL in a batch."""
        return "ts" if "ts" in self.columns else self.key[0]

    @property
    def partition_column(self) -> str:
        return "date" if self.partitioned else "slot"


_TYPES = {
    "ts": T.TimestampType(),
    "int": T.IntegerType(),
    "text": T.StringType(),
    "exact": T.DecimalType(38, 0),
    "real": T.DoubleType(),
    "flag": T.BooleanType(),
    "long": T.LongType(),
    "bytes": T.BinaryType(),
}

# Table names, column names, column types, column order and keys.
MARKET_STATE = TableSpec(
    "market_state",
    "ts ts, chain_id int, market_id text, total_supply_assets exact, total_supply_shares exact, "
    "total_borrow_assets exact, total_borrow_shares exact, rate_at_target exact, utilization real, "
    "oracle_price_raw text, api_timestamp ts, source text",
    ("chain_id", "market_id", "ts"),
    ("chain_id", "market_id"),
)
MARKETS = TableSpec(
    "markets",
    "chain_id int, market_id text, loan_token text, loan_symbol text, loan_decimals int, "
    "collateral_token text, collateral_symbol text, collateral_decimals int, oracle text, irm text, "
    "lltv exact, creation_ts ts, listed flag, fetched_at ts",
    ("chain_id", "market_id"),
    partitioned=False,
)
VAULT_ALLOCATIONS = TableSpec(
    "vault_allocations",
    "ts ts, chain_id int, vault text, market_id text, supply_assets exact, supply_shares exact, "
    "supply_cap exact, source text",
    ("chain_id", "vault", "market_id", "ts"),
    ("chain_id", "vault"),
)
POSITIONS = TableSpec(
    "positions",
    "ts ts, chain_id int, market_id text, borrower text, collateral exact, borrow_shares exact, "
    "borrow_assets exact, supply_shares exact, health_factor real",
    ("chain_id", "market_id", "borrower", "ts"),
    ("chain_id", "market_id"),
)
PRICES = TableSpec(
    "prices",
    "ts ts, chain_id int, token_address text, price_usd real, source text, confidence real",
    ("chain_id", "token_address", "ts"),
    ("chain_id", "token_address"),
)
YIELD_POOLS = TableSpec(
    "yield_pools",
    "ts ts, pool_id text, chain text, project text, symbol text, tvl_usd real, apy real, "
    "apy_base real, apy_reward real",
    ("pool_id", "ts"),
    ("pool_id",),
)
LEGACY_SNAPSHOTS = TableSpec(
    "legacy_snapshots",
    "ts ts, chain_id int, market_id text, symbol text, loan_token text, collateral_token text, "
    "utilization real, borrow_apy real, supply_apy real, available_liquidity real, "
    "vault_allocation real, source_file text",
    ("chain_id", "market_id", "ts"),
    ("chain_id", "market_id"),
)
BOT_SCORES = TableSpec(
    "bot_scores",
    "ts ts, chain_id int, vault text, tick_id text, market_id text, collateral_symbol text, "
    "loan_symbol text, u real, apy real, exit_ratio real, score real, gate text, vault_assets exact, "
    "total_assets exact, idle_assets exact, source_file text",
    ("vault", "ts", "market_id"),
    ("chain_id", "vault"),
)
BOT_EVENTS = TableSpec(
    "bot_events",
    "ts ts, chain_id int, tick_id text, seq int, type text, tx_hash text, block_number exact, "
    "payload text, source_file text",
    ("tick_id", "seq"),
    ("chain_id",),
)
VAULT_V2_STATE = TableSpec(
    "vault_v2_state",
    "ts ts, chain_id int, vault text, total_assets exact, idle_assets exact, total_supply exact, "
    "share_price real, total_assets_usd real",
    ("chain_id", "vault", "ts"),
    ("chain_id", "vault"),
)
MARKET_FLOWS = TableSpec(
    "market_flows",
    "ts ts, chain_id int, market_id text, block_number exact, tx_hash text, log_index int, type text, "
    "account text, assets exact, shares exact, liquidator text, repaid_assets exact, "
    "seized_assets exact, bad_debt_assets exact",
    ("tx_hash", "log_index"),
    ("chain_id", "market_id"),
)
SUPPLIER_POSITIONS = TableSpec(
    "supplier_positions",
    "ts ts, chain_id int, market_id text, supplier text, supply_shares exact, supply_assets exact",
    ("chain_id", "market_id", "supplier", "ts"),
    ("chain_id", "market_id"),
)
VAULT_V2_FLOWS = TableSpec(
    "vault_v2_flows",
    "ts ts, chain_id int, vault text, block_number exact, tx_hash text, log_index int, type text, "
    "sender text, receiver text, on_behalf text, assets exact, shares exact",
    ("tx_hash", "log_index"),
    ("chain_id", "vault"),
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        MARKET_STATE,
        MARKETS,
        VAULT_ALLOCATIONS,
        POSITIONS,
        PRICES,
        YIELD_POOLS,
        LEGACY_SNAPSHOTS,
        BOT_SCORES,
        BOT_EVENTS,
        VAULT_V2_STATE,
        VAULT_V2_FLOWS,
        MARKET_FLOWS,
        SUPPLIER_POSITIONS,
    )
}
