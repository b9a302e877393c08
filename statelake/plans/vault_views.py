"""Views over vault allocations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.functions import human, share_pct
from statelake.operators import at_newest, instants, latest_rows, share_within, with_previous

from .market_views import Tables, collateral_label, with_dimension

# Fixed value: share moves of at most this many percentage points are drift noise.
DRIFT_FLOOR_PP = 0.5


def v_vault_allocations(t: Tables) -> DataFrame:
    df = with_dimension(t["vault_allocations"], t, "loan_symbol", "collateral_symbol", "loan_decimals")
    return df.select(
        "ts", "chain_id", "vault", "market_id", "loan_symbol", "collateral_symbol",
        human("supply_assets", "loan_decimals").alias("supply_assets"),
        human("supply_cap", "loan_decimals").alias("supply_cap"),
        "source",
    )


def v_vault_snapshot(t: Tables) -> DataFrame:
    """Each vault's current allocation, share of the vault and cap usage."""
    now = share_within(latest_rows(at_newest(t["vault_allocations"], instants(t, "vault_allocations"), ["vault"]), ["vault"]), ["vault"], "supply_assets", "weight_pct")
    df = with_dimension(now, t, "loan_symbol", "collateral_symbol", "loan_decimals")
    return df.select(
        "ts", "vault", "loan_symbol", collateral_label(), "market_id",
        human("supply_assets", "loan_decimals").alias("supply_assets"),
        human("supply_cap", "loan_decimals").alias("supply_cap"),
        "weight_pct",
        share_pct("supply_assets", "supply_cap").alias("cap_used_pct"),
    )


def v_vault_drift(t: Tables) -> DataFrame:
    """Re-allocations: a market's share of its vault moved by more than the floor
    since the previous sample. A first sighting is no move."""
    seen = t["vault_allocations"].where("supply_assets is not null")
    df = share_within(seen, ["vault", "ts"], "supply_assets", "weight_pct")
    df = with_dimension(df, t, "loan_symbol", "collateral_symbol", "loan_decimals")
    df = df.withColumn("supply_assets", human("supply_assets", "loan_decimals"))
    before = {"supply_assets": "_amount_before", "weight_pct": "prev_weight_pct"}
    df = with_previous(df, ["vault", "market_id"], before)
    df = df.withColumn("weight_change_pct", F.col("weight_pct") - F.col("prev_weight_pct"))
    moved = df.where(F.abs("weight_change_pct") > DRIFT_FLOOR_PP)
    return moved.select(
        "ts", "chain_id", "vault", "market_id", "loan_symbol", collateral_label(), "supply_assets",
        (F.col("supply_assets") - F.col("_amount_before")).alias("supply_assets_change"),
        "prev_weight_pct", "weight_pct", "weight_change_pct",
    )
