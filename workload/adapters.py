"""The given tables in the shape of the stored ones.

Each builder has a twin of the same name in ``prelude.py``. The state and price
series are clock-sampled: the newest event of a cadence bucket stands for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.functions import floor_to
from statelake.operators import keep_one
from statelake.session import configure
from statelake.tables import TABLES
from statelake.sources.store import coerce

STATE_BUCKET, PRICE_BUCKET = 300, 900
# Fixed value: the stored tag of the second price source.
SECOND_SOURCE = "morpho"


# Declared, so that opening a table reads no footers.
GIVEN_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

_OPENED: dict[tuple, "Given"] = {}


def given(spark: SparkSession, sf_dir: str) -> "Given":
    """One ``Given`` per session and folder; its DataFrames are plans and can be shared."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _OPENED:
        _OPENED[key] = Given(spark, sf_dir)
    configure(spark)
    return _OPENED[key]


class Given:
    """Lazy access to one scale's tables, raw and adapted."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.dir = sf_dir
        self._adapted: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN_SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    def events(self) -> DataFrame:
        return self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))

    def table(self, name: str) -> DataFrame:
        if name not in self._adapted:
            self._adapted[name] = coerce(getattr(self, name)(), TABLES[name])
        return self._adapted[name]

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}

    # --- adapted tables ------------------------------------------------------

    def market_state(self) -> DataFrame:
        ev = self.events().select(
            "user_id", floor_to("ts", STATE_BUCKET).alias("bucket"), "ts", "event_id", "event_type", "value"
        )
        ev = keep_one(ev, ["user_id", "bucket"], F.struct("ts", "event_id"))
        v, kind = F.col("value"), F.col("event_type")
        full = F.least(v / 50.0, F.lit(1.0))
        return ev.select(
            F.col("bucket").alias("ts"), chain(F.col("user_id")), market(F.col("user_id")),
            exact((v + 1) * 1e8).alias("total_supply_assets"),
            exact((v + 1) * 1e10).alias("total_supply_shares"),
            exact(full * (v + 1) * 1e8).alias("total_borrow_assets"),
            exact(full * (v + 1) * 1e10).alias("total_borrow_shares"),
            F.when(~((kind == "signup") & (v < 2)), exact(v * 4e8)).alias("rate_at_target"),
            F.when(~((kind == "error") & (v < 5)), full).alias("utilization"),
            F.when((kind == "signup") & (v < 1), "n/a")
            .when(kind != "click", F.concat(digits(v * 100), F.repeat(F.lit("0"), 22)))
            .alias("oracle_price_raw"),
            F.col("ts").alias("api_timestamp"),
            F.when(kind == "error", "backfill").otherwise("live").alias("source"),
        )

    def markets(self) -> DataFrame:
        # Shifted, so that some markets of the events have no dimension row.
        k = F.col("c_custkey") + 3
        loan, coll = F.concat(F.lit("tok"), k % 5), F.concat(F.lit("tok"), 5 + k % 7)
        idle = F.col("c_mktsegment") == "HOUSEHOLD"
        return self.raw("customer").select(
            chain(k), market(k),
            F.when(k % 13 == 0, "tokx").otherwise(loan).alias("loan_token"),
            F.when(k % 13 == 0, "SYMX").when(k % 100 == 2, "SYM2B").otherwise(F.concat(F.lit("SYM"), k % 5)).alias("loan_symbol"),
            F.lit(6).alias("loan_decimals"),
            F.when(~idle, coll).alias("collateral_token"),
            F.when(~idle, F.concat(F.lit("COL"), 5 + k % 7)).alias("collateral_symbol"),
            F.when(~idle, 18).alias("collateral_decimals"),
            F.concat(F.lit("0xo"), k).alias("oracle"), F.concat(F.lit("0xi"), k % 4).alias("irm"),
            F.concat((F.lit(700) + k % 250).cast("string"), F.repeat(F.lit("0"), 15)).alias("lltv"),
            F.lit("2023-06-01 00:00:00").cast("timestamp").alias("creation_ts"),
            (F.col("c_acctbal") > 0).alias("listed"),
            F.lit("2024-01-31 00:00:00").cast("timestamp").alias("fetched_at"),
        )

    def prices(self) -> DataFrame:
        ev = self.events().where("event_type = 'view'").select(
            floor_to("ts", PRICE_BUCKET).alias("bucket"), chain(F.col("user_id")), token(F.col("user_id")),
            "ts", "event_id", "value",
        )
        ev = keep_one(ev, ["chain_id", "token_address", "bucket"], F.struct("ts", "event_id"))
        return ev.select(
            F.col("bucket").alias("ts"), "chain_id", "token_address", F.round(F.col("value") / 25.0, 4).alias("price_usd"),
            F.lit("llama").alias("source"), confidence().alias("confidence"),
        )

    def prices_secondary(self) -> DataFrame:
        """A second source of the same series, from other events."""
        ev = self.events().where("event_type = 'purchase'").select(
            floor_to("ts", PRICE_BUCKET).alias("bucket"), chain(F.col("user_id")), token(F.col("user_id")),
            "ts", "event_id", "value",
        )
        ev = keep_one(ev, ["chain_id", "token_address", "bucket"], F.struct("ts", "event_id"))
        return ev.select(
            F.col("bucket").alias("ts"), "chain_id", "token_address", F.round(F.col("value") / 25.0, 4).alias("price_usd"),
            F.lit(SECOND_SOURCE).alias("source"), F.lit(None).cast("double").alias("confidence"),
        )

    def market_flows(self) -> DataFrame:
        v, kind, i = F.col("value"), F.col("event_type"), F.col("event_id")
        liquidation = kind == "error"
        flow_type = (
            F.when((kind == "view") & (v < 10), "SupplyCollateral").when(kind == "view", "Supply")
            .when((kind == "click") & (v < 10), "WithdrawCollateral").when(kind == "click", "Withdraw")
            .when(kind == "signup", "Borrow").when(kind == "purchase", "Repay").otherwise("Liquidation")
        )
        transfer = kind.isin("signup", "purchase") | (kind.isin("view", "click") & (v >= 10))
        return self.events().select(
            "ts", chain(F.col("user_id")), market(F.col("user_id")),
            (i * 10).alias("block_number"), F.concat(F.lit("0x"), i).alias("tx_hash"), (i % 7).cast("int").alias("log_index"),
            flow_type.alias("type"), F.concat(F.lit("u"), i % 97).alias("account"),
            F.when(~liquidation & transfer, exact(v * 1e6))
            .when(~liquidation, F.concat(digits(v * 100), F.repeat(F.lit("0"), 16)))
            .alias("assets"),
            F.when(transfer, exact(v * 1e8)).alias("shares"),
            F.when(liquidation, F.concat(F.lit("q"), i % 11)).alias("liquidator"),
            F.when(liquidation, exact(v * 1e6)).alias("repaid_assets"),
            F.when(liquidation, F.concat(digits(v * 100), F.repeat(F.lit("0"), 16))).alias("seized_assets"),
            F.when(liquidation, F.when(v > 150, exact(v * 1e4)).otherwise("0")).alias("bad_debt_assets"),
        )

    def _book(self) -> DataFrame:
        """Orders as holdings: nation = market, customer = holder, month = snapshot."""
        orders = self.raw("orders").select("o_custkey", "o_orderdate", "o_totalprice")
        nation = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        return (
            orders.join(nation, "o_custkey")
            .groupBy("c_nationkey", "o_custkey", month.alias("ts"))
            .agg(F.sum(cents).alias("cents"))
        )

    def positions(self) -> DataFrame:
        k = F.col("o_custkey")
        return self._book().select(
            "ts", chain(F.col("c_nationkey")), market(F.col("c_nationkey")), F.concat(F.lit("b"), k).alias("borrower"),
            (F.col("cents") * 2).alias("collateral"), F.col("cents").alias("borrow_shares"),
            F.when(k % 17 != 0, F.col("cents")).alias("borrow_assets"), F.lit(0).alias("supply_shares"),
            F.when(k % 19 != 0, 1.0 + (k % 50) / 100.0).alias("health_factor"),
        )

    def supplier_positions(self) -> DataFrame:
        return self._book().select(
            "ts", chain(F.col("c_nationkey")), market(F.col("c_nationkey")),
            F.concat(F.lit("s"), F.col("o_custkey")).alias("supplier"),
            (F.col("cents") * 10).alias("supply_shares"),
            (F.floor(F.col("cents") / 1000000) * 1000000).alias("supply_assets"),
        )

    def vault_allocations(self) -> DataFrame:
        slot = line_slot()
        month = F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
        quantity, price = F.round("l_quantity").cast("bigint"), F.round("l_extendedprice").cast("bigint")
        sums = (
            self.raw("lineitem").groupBy("l_suppkey", slot.alias("slot"), month.alias("ts"))
            .agg(F.sum(quantity).alias("q"), F.sum(price).alias("p"))
        )
        return sums.select(
            "ts", chain(F.col("slot")), F.concat(F.lit("0xv"), F.col("l_suppkey")).alias("vault"), market(F.col("slot")),
            (F.col("q") * 1000000).alias("supply_assets"), (F.col("q") * 1000).alias("supply_shares"),
            F.when(F.col("slot") == 5, F.lit(0)).otherwise(F.col("p") * 1000).alias("supply_cap"), F.lit("live").alias("source"),
        )

    def bot_scores(self) -> DataFrame:
        # Every fourth user's purchases are scores.
        ev = self.events().where("event_type = 'purchase' and user_id % 4 = 1").select(
            "user_id", floor_to("ts", 60).alias("bucket"), "ts", "event_id", "value"
        )
        ev = keep_one(ev, ["user_id", "bucket"], F.struct("ts", "event_id"))
        return ev.select(
            F.col("bucket").alias("ts"), chain(F.col("user_id")), F.lit("0xV").alias("vault"),
            F.concat(F.lit("t"), F.col("event_id")).alias("tick_id"), market(F.col("user_id")),
            F.least(F.col("value") / 100.0, F.lit(1.0)).alias("u"), (F.col("value") / 1000.0).alias("score"),
        )


def exact(x: Column) -> Column:
    return F.round(x).cast("bigint").cast("decimal(38,0)").cast("string")


def digits(x: Column) -> Column:
    return F.round(x).cast("bigint").cast("string")


def chain(k: Column) -> Column:
    return (k % 3 + 1).cast("int").alias("chain_id")


def market(k: Column) -> Column:
    return F.concat(F.lit("m"), k).alias("market_id")


def token(k: Column) -> Column:
    """Few tokens, as in practice: the as-of keys are hot."""
    return F.concat(F.lit("tok"), F.floor(k / 3) % 12).alias("token_address")


def confidence() -> Column:
    return F.when(F.col("event_id") % 10 != 0, (F.col("event_id") % 100) / 100.0)


def line_slot() -> Column:
    """0..5 out of return flag and line status."""
    flag = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2)
    return flag + F.when(F.col("l_linestatus") == "O", 0).otherwise(3)
