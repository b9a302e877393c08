"""Views over the sampled market state.

``t`` maps stored table names to DataFrames. Joins to the market dimension carry
no hint: Catalyst broadcasts it while its statistics are under the threshold and
otherwise falls back to a sort-merge join that the adaptive planner un-skews.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statelake.functions import apy_at_target, borrow_rate, compound_three_terms, double, human, micros, text_price, wad
from statelake.operators import (
    ago, asof_join, at_newest, avg_where, indicator, instants, latch, latest_rows, latest_value, none_within, seen_within, with_leader_spread,
    throughout, tier,
)

Tables = Mapping[str, DataFrame]
MARKET = ["chain_id", "market_id"]

# Operator-tuned limits of the health rules and the benchmark tier.
RATCHET_ENTER_APY, RATCHET_EXIT_APY = 0.50, 0.25
PINNED_LEVEL, PINNED_HOURS, PINNED_SPAN_HOURS = 0.999, 24, 22
CALM_LEVEL, CALM_HOURS, CALM_SPAN_HOURS = 0.95, 48, 44
DUST_USD, THIN_USD = 1_000, 25_000
INVESTABLE_USD = 10_000
HIGH_UTILIZATION, FULL_UTILIZATION = 0.95, 0.99
IDLE = "IDLE"


def collateral_label() -> Column:
    return F.coalesce("collateral_symbol", F.lit(IDLE)).alias("collateral_symbol")


def with_dimension(df: DataFrame, t: Tables, *columns: str, how: str = "left") -> DataFrame:
    return df.join(t["markets"].select(*MARKET, *columns), MARKET, how)


def _free() -> Column:
    return F.col("total_supply_assets") - F.col("total_borrow_assets")


def v_market_state(t: Tables) -> DataFrame:
    """Human-unit state samples."""
    df = with_dimension(
        t["market_state"], t, "loan_symbol", "collateral_symbol", "lltv", "loan_decimals", "collateral_decimals"
    )
    return df.select(
        "ts", *MARKET, "loan_symbol", "collateral_symbol",
        wad("lltv").alias("lltv"),
        human("total_supply_assets", "loan_decimals").alias("supply_assets"),
        human("total_borrow_assets", "loan_decimals").alias("borrow_assets"),
        human(_free(), "loan_decimals").alias("liquidity"),
        "utilization",
        wad("rate_at_target").alias("rate_at_target_per_sec"),
        apy_at_target("rate_at_target").alias("apy_at_target"),
        text_price("oracle_price_raw", "loan_decimals", "collateral_decimals").alias("oracle_price"),
        "source",
    )


def v_liquidity_risk(t: Tables) -> DataFrame:
    """How often a market could not be left, over all history, and where it stands."""
    u = F.col("utilization")
    per_market = t["market_state"].groupBy(*MARKET).agg(
        F.count(F.lit(1)).alias("hours_observed"),
        (F.avg(indicator(u > HIGH_UTILIZATION)) * 100.0).alias("pct_time_gt95"),
        (F.avg(indicator(u > FULL_UTILIZATION)) * 100.0).alias("pct_time_gt99"),
        (F.avg(u) * 100.0).alias("avg_util_pct"),
        (latest_value("utilization") * 100.0).alias("current_util_pct"),
        (apy_at_target(latest_value("rate_at_target")) * 100.0).alias("current_apy_at_target_pct"),
    )
    return with_dimension(per_market, t, "loan_symbol", "collateral_symbol").select(
        *MARKET, "loan_symbol", collateral_label(), *per_market.columns[2:]
    )


def v_market_snapshot(t: Tables) -> DataFrame:
    """The newest sample of every market with its whole dimension."""
    newest = latest_rows(at_newest(t["market_state"], instants(t, "market_state"), MARKET), MARKET)
    df = with_dimension(newest, t, *[c for c in t["markets"].columns if c not in MARKET])
    return df.select(
        "ts", *MARKET, "loan_symbol", collateral_label(), "loan_token", "collateral_token", "oracle", "irm",
        "creation_ts", "listed",
        wad("lltv").alias("lltv"),
        human("total_supply_assets", "loan_decimals").alias("supply_assets"),
        human("total_borrow_assets", "loan_decimals").alias("borrow_assets"),
        human(_free(), "loan_decimals").alias("liquidity"),
        "utilization",
        apy_at_target("rate_at_target").alias("apy_at_target"),
        text_price("oracle_price_raw", "loan_decimals", "collateral_decimals").alias("oracle_price"),
    )


def v_utilization_regime(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Trailing 7- and 30-day utilization, relative to ``as_of`` (default: now)."""
    anchor = F.current_timestamp() if as_of is None else as_of
    u = F.col("utilization")
    week, month = F.col("ts") > ago(anchor, days=7), F.col("ts") > ago(anchor, days=30)
    aggs = []
    for label, value in (
        ("avg_util", u),
        ("pct_time_gt95", indicator(u > HIGH_UTILIZATION)),
        ("pct_time_gt99", indicator(u > FULL_UTILIZATION)),
    ):
        aggs += [(avg_where(value, week) * 100.0).alias(f"{label}_7d"), (avg_where(value, month) * 100.0).alias(f"{label}_30d")]
    per_market = t["market_state"].groupBy(*MARKET).agg(
        *aggs,
        (latest_value("utilization") * 100.0).alias("current_util_pct"),
        (apy_at_target(latest_value("rate_at_target")) * 100.0).alias("current_apy_at_target_pct"),
    )
    return with_dimension(per_market, t, "loan_symbol", "collateral_symbol").select(
        *MARKET, "loan_symbol", collateral_label(), *per_market.columns[2:]
    )


def apy_columns(df: DataFrame) -> DataFrame:
    """Adds the curve's borrow rate and compounded APYs (no protocol fee is stored)."""
    rate = borrow_rate(F.col("u"), F.col("_target"))
    df = df.withColumn("borrow_rate_per_sec", rate)
    return df.withColumn("borrow_apy", compound_three_terms(F.col("borrow_rate_per_sec"))).withColumn(
        "supply_apy", compound_three_terms(F.col("borrow_rate_per_sec") * F.col("u"))
    )


def v_market_apy(t: Tables) -> DataFrame:
    """Borrow and supply APY per sample with a known rate and utilization."""
    known = t["market_state"].where("rate_at_target is not null and utilization is not null")
    base = known.select("ts", *MARKET, F.col("utilization").alias("u"), wad("rate_at_target").alias("_target"))
    return apy_columns(base).drop("_target")


def health_panel(t: Tables, start: Column | None = None) -> DataFrame:
    """Every sample (from ``start`` on) with its health state and what the APY views need.

    The latches need no price: they run over all history in windows that share the
    (chain, market) partitioning and the time order, then the rows wanted are cut out,
    and only these meet the prices. An entity has one row per cadence bucket, so a
    window partition is bounded by the time span.
    """
    state = with_dimension(
        t["market_state"], t, "loan_symbol", "collateral_symbol", "loan_token", "collateral_token",
        "loan_decimals", "collateral_decimals", "lltv",
    ).select(
        "ts", *MARKET,
        F.col("utilization").alias("u"),
        wad("rate_at_target").alias("_target"),
        apy_at_target("rate_at_target").alias("apy_at_target"),
        human("total_supply_assets", "loan_decimals").alias("_supply"),
        human(_free(), "loan_decimals").alias("_available"),
        F.lower("loan_token").alias("_loan_token"),
        "loan_symbol", "collateral_symbol", "collateral_token", "lltv", "oracle_price_raw",
        "loan_decimals", "collateral_decimals",
    )
    apy = F.col("apy_at_target")
    df = state.withColumn("_t", micros("ts")).withColumn(
        "_ratchet_event", F.when(apy > RATCHET_ENTER_APY, 1).when(apy < RATCHET_EXIT_APY, 0))
    pinned = throughout(F.col("u") >= PINNED_LEVEL, MARKET, PINNED_HOURS, PINNED_SPAN_HOURS)
    calm = (
        none_within(F.col("u") >= CALM_LEVEL, MARKET, CALM_HOURS)
        & seen_within(F.col("u").isNotNull(), MARKET, CALM_HOURS)
        & seen_within(F.lit(True), MARKET, CALM_HOURS, CALM_SPAN_HOURS)
    )
    latched = (
        df.withColumn("_pinned_event", F.when(pinned, 1).when(calm, 0))
        .withColumn("_ratcheted", latch(F.col("_ratchet_event"), MARKET))
        .withColumn("_pinned", latch(F.col("_pinned_event"), MARKET))
    )
    wanted = latched if start is None else latched.where(F.col("ts") >= start)
    priced = asof_join(
        wanted, t["prices"],
        keys=[("chain_id", "chain_id"), ("_loan_token", "token_address")],
        take={"price_usd": "_loan_price"},
        identity=[*MARKET, "ts"],
        # The same rows without the windows, for the group sizes.
        sizes_from=state if start is None else state.where(F.col("ts") >= start),
    )
    return (
        priced.withColumn("supply_usd", F.col("_supply") * F.col("_loan_price"))
        .withColumn("available_usd", F.col("_available") * F.col("_loan_price"))
        .withColumn("_thin", F.coalesce(F.col("supply_usd") < THIN_USD, F.lit(True)))
        .withColumn("_dust", F.coalesce(F.col("supply_usd") < DUST_USD, F.lit(False)))
        .withColumn("is_broken", F.col("_dust") | ((F.col("_ratcheted") | F.col("_pinned")) & F.col("_thin")))
        .withColumn(
            "broken_reason",
            F.when(F.col("_dust"), "dust")
            .when(F.col("_ratcheted") & F.col("_thin"), "rate_ratchet")
            .when(F.col("_pinned") & F.col("_thin"), "pinned_util"),
        )
    )


def v_market_health(t: Tables) -> DataFrame:
    """Broken-market classification with hysteresis."""
    return health_panel(t).select(
        "ts", *MARKET, "u", "apy_at_target", "supply_usd", "available_usd", "is_broken", "broken_reason"
    )


def rated_panel(t: Tables) -> DataFrame:
    """Health and APY of the same sample side by side: both derive from one row
    of the state table, so no join is needed to pair them."""
    return apy_columns(health_panel(t).where("_target is not null and u is not null"))


def v_apy_spread(t: Tables) -> DataFrame:
    """Distance to the best market that is not broken, per chain and instant."""
    df = rated_panel(t)
    df = df.select("ts", *MARKET, "supply_apy", "is_broken")
    return with_leader_spread(df, "spread_to_best", "supply_apy", ~F.col("is_broken"), ["chain_id", "ts"])


def v_benchmark(t: Tables) -> DataFrame:
    """Passive counterfactuals per chain and instant: all sound markets, those
    with room to enter, and the scored set."""
    scored = t["bot_scores"].select("market_id").where("market_id is not null").distinct()
    df = rated_panel(t).join(scored.withColumn("_scored", F.lit(True)), "market_id", "left")
    sound = ~F.col("is_broken")
    roomy = sound & F.coalesce(F.col("available_usd") >= INVESTABLE_USD, F.lit(False))
    apy = F.col("supply_apy")
    names = {
        "equal_weight_apy best_market_apy markets": sound,
        "investable_equal_weight_apy investable_best_apy investable_markets": roomy,
        "bot_equal_weight_apy bot_best_apy bot_markets": F.coalesce("_scored", F.lit(False)),
    }
    aggs = [a.alias(n) for label, member in names.items() for a, n in zip(tier(apy, member), label.split())]
    return (
        df.groupBy("ts", "chain_id")
        .agg(*aggs)
        .withColumn("opportunity_gap_apy", F.col("best_market_apy") - F.col("bot_best_apy"))
        .withColumn("deployable_gap_apy", F.col("investable_best_apy") - F.col("bot_best_apy"))
    )


def oracle_deviation(state: DataFrame, prices: DataFrame, **options) -> DataFrame:
    """Oracle price against the reference cross rate for samples that carry both
    the dimension columns and an oracle price. ``options`` go to the as-of joins."""
    # A lookup keeps every row: all of them take their group sizes from the rows before the first.
    base = priced = state.withColumn("_loan", F.lower("loan_token")).withColumn("_coll", F.lower("collateral_token"))
    for key, out in (("_loan", "loan_price_usd"), ("_coll", "collateral_price_usd")):
        priced = asof_join(
            priced, prices, keys=[("chain_id", "chain_id"), (key, "token_address")], take={"price_usd": out},
            identity=[*MARKET, "ts"], sizes_from=base, **options,
        )
    reference = F.col("collateral_price_usd") / F.nullif("loan_price_usd", F.lit(0.0))
    return (
        priced.withColumn("oracle_price", text_price("oracle_price_raw", "loan_decimals", "collateral_decimals"))
        .withColumn("ref_price", reference)
        .withColumn("deviation", F.col("oracle_price") / F.nullif("ref_price", F.lit(0.0)) - 1.0)
    )


def oracle_samples(t: Tables) -> DataFrame:
    """Samples with an oracle price, of markets with a collateral token."""
    state = t["market_state"].where("oracle_price_raw is not null").select("ts", *MARKET, "oracle_price_raw")
    dims = ["loan_symbol", "collateral_symbol", "loan_token", "collateral_token", "loan_decimals", "collateral_decimals"]
    return with_dimension(state, t, *dims, how="inner").where("collateral_token is not null")


def v_oracle_price_check(t: Tables) -> DataFrame:
    """Oracle versus reference price per live sample."""
    return oracle_deviation(oracle_samples(t), t["prices"]).select(
        "ts", *MARKET, "loan_symbol", "collateral_symbol", "oracle_price", "ref_price",
        "loan_price_usd", "collateral_price_usd", "deviation",
    )
