"""Views over the market event tape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statelake.functions import human
from statelake.operators import asof_join, count_where, sum_where

from .market_views import MARKET, Tables, collateral_label, with_dimension

# Event type names and the whale floor (share of market supply).
LOAN_TYPES = ["Supply", "Withdraw", "Borrow", "Repay"]
COLLATERAL_TYPES = ["SupplyCollateral", "WithdrawCollateral"]
LIQUIDATION = "Liquidation"
WHALE_SHARE = 0.05

EVENT = ["tx_hash", "log_index"]
_DIMS = ["loan_symbol", "collateral_symbol", "loan_decimals", "collateral_decimals"]


def _of_type(*names: str) -> Column:
    return F.col("type").isin(*names)


def signed_flows(df: DataFrame) -> DataFrame:
    """Adds signed loan-unit deltas of supply and debt. A liquidation repays debt
    and, where debt stays unpaid, takes the loss out of supply."""
    loan = lambda c: human(c, "loan_decimals")
    return df.withColumn(
        "supply_flow",
        F.when(_of_type("Supply"), loan("assets"))
        .when(_of_type("Withdraw"), -loan("assets"))
        .when(_of_type(LIQUIDATION), -loan("bad_debt_assets")),
    ).withColumn(
        "borrow_flow",
        F.when(_of_type("Borrow"), loan("assets"))
        .when(_of_type("Repay"), -loan("assets"))
        .when(_of_type(LIQUIDATION), -loan("repaid_assets")),
    )


def v_market_flows(t: Tables) -> DataFrame:
    """Every event in human units."""
    df = signed_flows(with_dimension(t["market_flows"], t, *_DIMS))
    return df.select(
        "ts", *MARKET, "loan_symbol", collateral_label(), "block_number", "tx_hash", "log_index", "type", "account",
        F.when(_of_type(*LOAN_TYPES), human("assets", "loan_decimals")).alias("loan_assets"),
        F.when(_of_type(*COLLATERAL_TYPES), human("assets", "collateral_decimals")).alias("collateral_assets"),
        "liquidator",
        human("repaid_assets", "loan_decimals").alias("repaid_assets"),
        human("seized_assets", "collateral_decimals").alias("seized_assets"),
        human("bad_debt_assets", "loan_decimals").alias("bad_debt_assets"),
        "supply_flow", "borrow_flow",
    )


def net_flow_aggregates() -> list[Column]:
    s, b = F.col("supply_flow"), F.col("borrow_flow")
    return [
        sum_where(s, s > 0).alias("supply_in"),
        sum_where(-s, s < 0).alias("supply_out"),
        F.coalesce(F.sum(s), F.lit(0.0)).alias("net_supply_flow"),
        sum_where(b, b > 0).alias("borrow_in"),
        sum_where(-b, b < 0).alias("borrow_out"),
        F.coalesce(F.sum(b), F.lit(0.0)).alias("net_borrow_flow"),
        F.count(F.lit(1)).alias("n_events"),
        count_where(F.col("type") == LIQUIDATION).alias("n_liquidations"),
    ]


def v_market_netflow(t: Tables) -> DataFrame:
    """Gross and net flow per market and hour; hours without events have no row."""
    keys = [F.date_trunc("hour", "ts").alias("ts"), *MARKET, "loan_symbol", "collateral_symbol"]
    return v_market_flows(t).groupBy(*keys).agg(*net_flow_aggregates())


def v_liquidations(t: Tables) -> DataFrame:
    """Liquidations sized in USD by the newest earlier price of either token."""
    only = t["market_flows"].where(_of_type(LIQUIDATION))
    df = with_dimension(only, t, *_DIMS, "loan_token", "collateral_token").select(
        "ts", *MARKET, "loan_symbol", "collateral_symbol", "tx_hash", "log_index",
        F.col("account").alias("borrower"), "liquidator",
        human("repaid_assets", "loan_decimals").alias("repaid_assets"),
        human("seized_assets", "collateral_decimals").alias("seized_assets"),
        human("bad_debt_assets", "loan_decimals").alias("bad_debt_assets"),
        F.lower("loan_token").alias("_loan"), F.lower("collateral_token").alias("_coll"),
    )
    base = df
    for key, out in (("_loan", "_loan_price"), ("_coll", "_coll_price")):
        df = asof_join(
            df, t["prices"], keys=[("chain_id", "chain_id"), (key, "token_address")], take={"price_usd": out},
            identity=EVENT, sizes_from=base,
        )
    return df.select(
        "ts", *MARKET, "loan_symbol", "collateral_symbol", "tx_hash", "borrower", "liquidator",
        "repaid_assets", "seized_assets", "bad_debt_assets",
        (F.col("repaid_assets") * F.col("_loan_price")).alias("repaid_usd"),
        (F.col("seized_assets") * F.col("_coll_price")).alias("seized_usd"),
    )


def v_whale_flows(t: Tables) -> DataFrame:
    """Single events of at least 5 % of the market's supply just before them.

    The debt side comes first: a liquidation's supply delta is its bad debt,
    usually nothing.
    """
    flows = signed_flows(with_dimension(t["market_flows"], t, *_DIMS)).select(
        "ts", *MARKET, "loan_symbol", collateral_label(), "tx_hash", "log_index", "type", "account", "loan_decimals",
        F.coalesce("borrow_flow", "supply_flow").alias("flow"),
    )
    sized = asof_join(
        flows.where("flow is not null"), t["market_state"],
        keys=[("chain_id", "chain_id"), ("market_id", "market_id")],
        take={"total_supply_assets": "_supply"},
        identity=EVENT,
    ).withColumn("market_supply", human("_supply", "loan_decimals"))
    supply = F.col("market_supply")
    large = sized.where((supply > 0) & (F.abs("flow") >= F.lit(WHALE_SHARE) * supply))
    return large.select(
        "ts", *MARKET, "loan_symbol", "collateral_symbol", "tx_hash", "type", "account", "flow", "market_supply",
        (F.abs("flow") * 100.0 / supply).alias("pct_of_supply"),
    )
