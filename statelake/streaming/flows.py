"""Event tape: late events, duplicates, hourly net flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.plans.flow_views import net_flow_aggregates, signed_flows
from statelake.plans.market_views import MARKET, collateral_label

# Lateness allowed for events, and their identity.
LATENESS = "1 hour"
EVENT_KEY = ["tx_hash", "log_index"]


def deduplicated(events: DataFrame) -> DataFrame:
    """Each event once, however often it is delivered within the lateness."""
    return events.withWatermark("ts", LATENESS).dropDuplicatesWithinWatermark(EVENT_KEY)


def hourly_net_flow(events: DataFrame, markets: DataFrame) -> DataFrame:
    """Net flow per market and closed hour, from an event stream and the static dimension."""
    dims = markets.select(*MARKET, "loan_symbol", "collateral_symbol", "loan_decimals", "collateral_decimals")
    sized = signed_flows(deduplicated(events).join(dims, MARKET, "left"))
    labelled = sized.withColumn("collateral_symbol", collateral_label())
    hour = F.window("ts", "1 hour")
    return (
        labelled.groupBy(hour, *MARKET, "loan_symbol", "collateral_symbol")
        .agg(*net_flow_aggregates())
        .select(F.col("window.start").alias("ts"), *MARKET, "loan_symbol", "collateral_symbol",
                "supply_in", "supply_out", "net_supply_flow", "borrow_in", "borrow_out", "net_borrow_flow",
                "n_events", "n_liquidations")
    )
