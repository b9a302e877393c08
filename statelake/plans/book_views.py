"""Views over holder books (all holders of a market at one instant).

A stored book is read at the newest instants it names, from the days that hold them.
Each snapshot is reduced by partial aggregation before anything is shuffled and
the newest one is picked from the reduced rows, so a book that names none is neither
joined to its own maximum nor gathered per market.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.functions import double, human, share_pct
from statelake.operators import at_newest, count_where, instants, latest_per_group, top_k_sum

from .market_views import MARKET, Tables, collateral_label, with_dimension

# Health factor that counts as close to liquidation, size of the top group.
NEAR_LIQUIDATION = 1.05
TOP = 3


def _newest_book(t: Tables, name: str, amount: str, *aggs) -> DataFrame:
    """Aggregates, the total and the top-k sum of every market's newest snapshot."""
    snapshot = [*MARKET, "ts"]
    book = at_newest(t[name], instants(t, name), MARKET)
    totals = book.groupBy(*snapshot).agg(
        F.count(F.lit(1)).alias("_holders"), double(F.sum(amount)).alias("_total"), *aggs
    )
    newest = latest_per_group(totals, MARKET)
    largest = top_k_sum(book, snapshot, amount, TOP, "_top")
    joined = newest.join(largest, snapshot, "left")
    return with_dimension(joined, t, "loan_symbol", "collateral_symbol", "loan_decimals")


def v_position_risk(t: Tables) -> DataFrame:
    """Debt close to liquidation and debt concentration."""
    near = F.col("health_factor") < NEAR_LIQUIDATION
    df = _newest_book(
        t, "positions", "borrow_assets",
        F.min("health_factor").alias("min_hf"),
        count_where(near).alias("borrowers_hf_lt_105"),
        F.coalesce(double(F.sum(F.when(near, F.col("borrow_assets")))), F.lit(0.0)).alias("_near"),
    )
    return df.select(
        *MARKET, "loan_symbol", collateral_label(), "ts",
        F.col("_holders").alias("borrowers"),
        human("_total", "loan_decimals").alias("total_borrow"),
        "min_hf", "borrowers_hf_lt_105",
        human("_near", "loan_decimals").alias("debt_hf_lt_105"),
        share_pct("_near", "_total").alias("pct_debt_hf_lt_105"),
        share_pct("_top", "_total").alias("top3_debt_pct"),
    )


def v_supplier_concentration(t: Tables) -> DataFrame:
    """Who could move a market by leaving. Equal top amounts: the first supplier by name."""
    amount = double("supply_assets")
    by_size = F.struct((-amount).alias("size"), F.col("supplier"))
    df = _newest_book(
        t, "supplier_positions", "supply_assets",
        F.min_by("supplier", F.when(amount.isNotNull(), by_size)).alias("top1_supplier"),
        F.max(amount).alias("_largest"),
    )
    return df.select(
        *MARKET, "loan_symbol", collateral_label(), "ts",
        F.col("_holders").alias("suppliers"),
        human("_total", "loan_decimals").alias("total_supply"),
        "top1_supplier",
        share_pct("_largest", "_total").alias("top1_supply_pct"),
        share_pct("_top", "_total").alias("top3_supply_pct"),
    )
