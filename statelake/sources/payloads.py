"""Landed API payloads (one JSON document per row) to table rows.

Every function takes a DataFrame with a ``payload`` text column, plus the context
columns its docstring names, and returns rows of one stored table. Integers that
may arrive as a JSON number or as digits in a string are declared as text in the
payload schema and cast to DECIMAL(38,0), so no digit is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statelake.functions.clock import floor_to, from_unix
from statelake.operators import keep_one

HOUR = 3600
EXACT = "decimal(38,0)"

# Payload type tag, source tags, and series name -> column.
LIQUIDATION_TAG = "MarketTransactionLiquidationData"
LIVE, BACKFILL = "live", "backfill"
PRICE_CURRENT, PRICE_CHART = "llama", "llama_chart"
FALLBACK_CURRENT, FALLBACK_HISTORY = "morpho", "morpho_history"
STATE_SERIES = {
    "supplyAssets": "total_supply_assets",
    "supplyShares": "total_supply_shares",
    "borrowAssets": "total_borrow_assets",
    "borrowShares": "total_borrow_shares",
    "rateAtTarget": "rate_at_target",
    "utilization": "utilization",
}
VAULT_FLOW_TYPES = ["Deposit", "Withdraw"]


def _documents(raw: DataFrame, schema: str, *context: str) -> DataFrame:
    return raw.select(*context, F.from_json("payload", schema).alias("d"))


def _in_order(raw: DataFrame) -> DataFrame:
    """``raw`` with ``doc_order``: of several documents of one entity, a later one replaces an
    earlier one's rows. The column may be left out where every entity has one document."""
    return raw if "doc_order" in raw.columns else raw.withColumn("doc_order", F.lit(0))


def _items(raw: DataFrame, item: str, *context: str) -> DataFrame:
    """One row per element of the document's ``items`` list, as ``it``."""
    return _documents(raw, f"items array<struct<{item}>>", *context).select(
        *context, F.explode("d.items").alias("it")
    )


def _exact(path: str) -> Column:
    return F.col(path).cast(EXACT)


def _address(path: str) -> Column:
    return F.nullif(F.lower(path), F.lit(""))


def _nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


# --- market state ------------------------------------------------------------

_STATE_ITEM = (
    "marketId:string,chain:struct<id:int>,state:struct<timestamp:string,supplyAssets:string,"
    "supplyShares:string,borrowAssets:string,borrowShares:string,rateAtTarget:string,"
    "utilization:double,price:string>"
)


def market_state_live(raw: DataFrame) -> DataFrame:
    """Context: ``ts`` (cadence bucket). Items without a state are dropped."""
    items = _items(raw, _STATE_ITEM, "ts").where("it.state is not null")
    stamp = F.nullif(F.col("it.state.timestamp").cast("double"), F.lit(0.0))
    return items.select(
        "ts",
        F.col("it.chain.id").alias("chain_id"),
        F.col("it.marketId").alias("market_id"),
        *[_exact(f"it.state.{s}").alias(c) for s, c in STATE_SERIES.items() if s != "utilization"],
        F.col("it.state.utilization").alias("utilization"),
        F.col("it.state.price").alias("oracle_price_raw"),
        from_unix(stamp).alias("api_timestamp"),
        F.lit(LIVE).alias("source"),
    )


def market_state_history(raw: DataFrame) -> DataFrame:
    """Context: ``chain_id``. Six unordered point series become one row per hour.

    Per (hour, column) the point with the greatest x wins, the later-listed one
    among equals; a series without a point in an hour leaves NULL.
    """
    points = ",".join(f"{s}:array<struct<x:double,y:string>>" for s in STATE_SERIES)
    docs = _documents(_in_order(raw), f"marketId string, historicalState struct<{points}>", "chain_id", "doc_order")
    tagged = F.array(
        *[
            F.struct(F.lit(c).alias("series"), F.col(f"d.historicalState.{s}").alias("points"))
            for s, c in STATE_SERIES.items()
        ]
    )
    flat = (
        docs.select("chain_id", "doc_order", F.col("d.marketId").alias("market_id"), F.inline(tagged))
        .select("chain_id", "doc_order", "market_id", "series", F.posexplode("points").alias("pos", "p"))
        .withColumn("ts", floor_to(from_unix("p.x"), HOUR))
    )
    rank = F.struct("p.x", "pos")

    def newest(column: str) -> Column:
        # A point whose value is null still wins its hour.
        return F.max_by(F.struct("p.y"), F.when(F.col("series") == column, rank))["y"]

    by_document = flat.groupBy("chain_id", "market_id", "ts", "doc_order").agg(*[newest(c).alias(c) for c in STATE_SERIES.values()])
    return (
        keep_one(by_document, ["chain_id", "market_id", "ts"], F.col("doc_order"))
        .select(
            "ts", "chain_id", "market_id",
            *[F.col(c).cast("double" if c == "utilization" else EXACT).alias(c) for c in STATE_SERIES.values()],
            _nothing("string").alias("oracle_price_raw"),
            _nothing("timestamp").alias("api_timestamp"),
            F.lit(BACKFILL).alias("source"),
        )
    )


# --- dimension ---------------------------------------------------------------

_ASSET = "struct<address:string,symbol:string,decimals:int>"
_META_ITEM = (
    "marketId:string,chain:struct<id:int>,lltv:string,oracleAddress:string,irmAddress:string,"
    f"creationTimestamp:string,listed:boolean,loanAsset:{_ASSET},collateralAsset:{_ASSET}"
)


def market_dimension(raw: DataFrame) -> DataFrame:
    """Context: ``fetched_at``. An idle market has no collateral asset."""
    born = F.nullif(F.col("it.creationTimestamp").cast("double"), F.lit(0.0))
    return _items(raw, _META_ITEM, "fetched_at").select(
        F.col("it.chain.id").alias("chain_id"),
        F.col("it.marketId").alias("market_id"),
        _address("it.loanAsset.address").alias("loan_token"),
        F.col("it.loanAsset.symbol").alias("loan_symbol"),
        F.col("it.loanAsset.decimals").alias("loan_decimals"),
        _address("it.collateralAsset.address").alias("collateral_token"),
        F.col("it.collateralAsset.symbol").alias("collateral_symbol"),
        F.col("it.collateralAsset.decimals").alias("collateral_decimals"),
        _address("it.oracleAddress").alias("oracle"),
        _address("it.irmAddress").alias("irm"),
        _exact("it.lltv").alias("lltv"),
        from_unix(born).alias("creation_ts"),
        F.col("it.listed").alias("listed"),
        "fetched_at",
    )


def market_universe(raw: DataFrame) -> DataFrame:
    """Context: ``chain_id``. Whole-chain scan: market and its USD supply (unknown = 0)."""
    items = _items(raw, "marketId:string,state:struct<supplyAssetsUsd:double>", "chain_id")
    return items.select(
        "chain_id",
        F.col("it.marketId").alias("market_id"),
        F.coalesce("it.state.supplyAssetsUsd", F.lit(0.0)).alias("supply_usd"),
    )


# --- vault allocations -------------------------------------------------------


def vault_allocations_live(raw: DataFrame) -> DataFrame:
    """Context: ``chain_id``, ``ts``. A vault without allocations gives no row."""
    slot = "struct<supplyAssets:string,supplyShares:string,supplyCap:string,market:struct<marketId:string>>"
    docs = _documents(raw, f"address string, state struct<allocation:array<{slot}>>", "chain_id", "ts")
    return docs.select(
        "ts", "chain_id", F.lower("d.address").alias("vault"), F.explode("d.state.allocation").alias("a")
    ).select(
        "ts", "chain_id", "vault",
        F.col("a.market.marketId").alias("market_id"),
        _exact("a.supplyAssets").alias("supply_assets"),
        _exact("a.supplyShares").alias("supply_shares"),
        _exact("a.supplyCap").alias("supply_cap"),
        F.lit(LIVE).alias("source"),
    )


def vault_allocations_history(raw: DataFrame) -> DataFrame:
    """Context: ``chain_id``, ``doc_order``. Hourly rows; the last listed point of an hour wins per column."""
    point = "array<struct<x:double,y:string>>"
    slot = f"struct<market:struct<marketId:string>,supplyAssets:{point},supplyCap:{point}>"
    docs = _documents(_in_order(raw), f"address string, historicalState struct<allocation:array<{slot}>>", "chain_id", "doc_order")
    slots = docs.select(
        "chain_id", "doc_order", F.lower("d.address").alias("vault"),
        F.posexplode("d.historicalState.allocation").alias("slot", "a"),
    )
    tagged = F.array(
        F.struct(F.lit("supply_assets").alias("series"), F.col("a.supplyAssets").alias("points")),
        F.struct(F.lit("supply_cap").alias("series"), F.col("a.supplyCap").alias("points")),
    )
    flat = (
        slots.select("chain_id", "doc_order", "vault", F.col("a.market.marketId").alias("market_id"), "slot", F.inline(tagged))
        .select("chain_id", "doc_order", "vault", "market_id", "slot", "series", F.posexplode("points").alias("pos", "p"))
        .withColumn("ts", floor_to(from_unix("p.x"), HOUR))
    )

    def last_listed(column: str) -> Column:
        rank = F.when(F.col("series") == column, F.struct("slot", "pos"))
        return F.max_by(F.struct("p.y"), rank)["y"].cast(EXACT).alias(column)

    by_document = flat.groupBy("chain_id", "vault", "market_id", "ts", "doc_order").agg(last_listed("supply_assets"), last_listed("supply_cap"))
    return (
        keep_one(by_document, ["chain_id", "vault", "market_id", "ts"], F.col("doc_order"))
        .select(
            "ts", "chain_id", "vault", "market_id", "supply_assets",
            _nothing(EXACT).alias("supply_shares"), "supply_cap", F.lit(BACKFILL).alias("source"),
        )
    )


# --- holder books ------------------------------------------------------------

_MARKET = "market:struct<marketId:string,chain:struct<id:int>>"
_USER = "user:struct<address:string>"


def borrower_positions(raw: DataFrame) -> DataFrame:
    """Context: ``ts``. Holders without borrow shares are not part of the book."""
    state = "state:struct<collateral:string,borrowShares:string,borrowAssets:string,supplyShares:string>"
    items = _items(raw, f"{_USER},{_MARKET},healthFactor:double,{state}", "ts")
    return items.where(_exact("it.state.borrowShares") >= 1).select(
        "ts",
        F.col("it.market.chain.id").alias("chain_id"),
        F.col("it.market.marketId").alias("market_id"),
        F.lower("it.user.address").alias("borrower"),
        _exact("it.state.collateral").alias("collateral"),
        _exact("it.state.borrowShares").alias("borrow_shares"),
        _exact("it.state.borrowAssets").alias("borrow_assets"),
        _exact("it.state.supplyShares").alias("supply_shares"),
        F.col("it.healthFactor").alias("health_factor"),
    )


def supplier_positions(raw: DataFrame) -> DataFrame:
    """Context: ``ts``. Holders without supply shares are not part of the book."""
    items = _items(raw, f"{_USER},{_MARKET},state:struct<supplyShares:string,supplyAssets:string>", "ts")
    return items.where(_exact("it.state.supplyShares") >= 1).select(
        "ts",
        F.col("it.market.chain.id").alias("chain_id"),
        F.col("it.market.marketId").alias("market_id"),
        F.lower("it.user.address").alias("supplier"),
        _exact("it.state.supplyShares").alias("supply_shares"),
        _exact("it.state.supplyAssets").alias("supply_assets"),
    )


# --- event tapes -------------------------------------------------------------


def market_flows(raw: DataFrame) -> DataFrame:
    """Events with a tagged-union body; liquidations never carry ``assets``."""
    body = (
        "data:struct<__typename:string,assets:string,shares:string,liquidator:string,"
        "repaidAssets:string,seizedAssets:string,badDebtAssets:string>"
    )
    head = "txHash:string,logIndex:int,blockNumber:string,timestamp:string,type:string"
    liquidation = F.coalesce(F.col("it.data.__typename") == LIQUIDATION_TAG, F.lit(False))
    return _items(raw, f"{head},{_USER},{_MARKET},{body}").select(
        from_unix("it.timestamp").alias("ts"),
        F.col("it.market.chain.id").alias("chain_id"),
        F.col("it.market.marketId").alias("market_id"),
        _exact("it.blockNumber").alias("block_number"),
        F.lower("it.txHash").alias("tx_hash"),
        F.col("it.logIndex").alias("log_index"),
        F.col("it.type").alias("type"),
        F.lower("it.user.address").alias("account"),
        F.when(~liquidation, _exact("it.data.assets")).alias("assets"),
        _exact("it.data.shares").alias("shares"),
        _address("it.data.liquidator").alias("liquidator"),
        _exact("it.data.repaidAssets").alias("repaid_assets"),
        _exact("it.data.seizedAssets").alias("seized_assets"),
        _exact("it.data.badDebtAssets").alias("bad_debt_assets"),
    )


def vault_v2_flows(raw: DataFrame) -> DataFrame:
    """Deposits and withdrawals; an empty address is no address."""
    head = "txHash:string,logIndex:int,blockNumber:string,timestamp:string,type:string,assets:string,shares:string"
    vault = "vault:struct<address:string,chain:struct<id:int>>"
    body = "data:struct<sender:string,receiver:string,onBehalf:string>"
    return _items(raw, f"{head},{vault},{body}").where(F.col("it.type").isin(VAULT_FLOW_TYPES)).select(
        from_unix("it.timestamp").alias("ts"),
        F.col("it.vault.chain.id").alias("chain_id"),
        F.lower("it.vault.address").alias("vault"),
        _exact("it.blockNumber").alias("block_number"),
        F.lower("it.txHash").alias("tx_hash"),
        F.col("it.logIndex").alias("log_index"),
        F.col("it.type").alias("type"),
        _address("it.data.sender").alias("sender"),
        _address("it.data.receiver").alias("receiver"),
        _address("it.data.onBehalf").alias("on_behalf"),
        _exact("it.assets").alias("assets"),
        _exact("it.shares").alias("shares"),
    )


# --- prices ------------------------------------------------------------------


def prices_current(raw: DataFrame, slug_to_chain: dict[str, int]) -> DataFrame:
    """Context: ``ts``. Keys read ``slug:address``; unknown slugs and null prices are dropped."""
    coins = _documents(raw, "coins map<string,struct<price:double,confidence:double>>", "ts").select(
        "ts", F.explode("d.coins").alias("k", "coin")
    )
    pairs = [part for slug, chain in slug_to_chain.items() for part in (F.lit(slug), F.lit(chain))]
    chain_of = F.create_map(*pairs)
    colon = F.instr("k", ":")
    return (
        coins.withColumn("chain_id", F.try_element_at(chain_of, F.substring_index("k", ":", 1)))
        .where("chain_id is not null and coin.price is not null")
        .select(
            "ts", "chain_id",
            F.when(colon > 0, F.lower(F.substr("k", colon + 1))).otherwise("").alias("token_address"),
            F.col("coin.price").alias("price_usd"),
            F.lit(PRICE_CURRENT).alias("source"),
            F.col("coin.confidence").alias("confidence"),
        )
    )


def _hourly_last(points: DataFrame, when: str, price: str, confidence: Column, source: str) -> DataFrame:
    """Last listed priced point of the last document per token and hour."""
    return (
        points.where(F.col(price).isNotNull())
        .withColumn("ts", floor_to(from_unix(when), HOUR))
        .groupBy("ts", "chain_id", F.lower("address").alias("token_address"))
        .agg(F.max_by(F.struct(F.col(price).alias("price"), confidence.alias("confidence")), F.struct("doc_order", "pos")).alias("p"))
        .select(
            "ts", "chain_id", "token_address",
            F.col("p.price").alias("price_usd"), F.lit(source).alias("source"), F.col("p.confidence").alias("confidence"),
        )
    )


def prices_chart(raw: DataFrame) -> DataFrame:
    """Context: ``chain_id``, ``address``, ``doc_order``. Hourly history of one token per document."""
    schema = "prices array<struct<timestamp:double,price:double,confidence:double>>"
    points = _documents(_in_order(raw), schema, "chain_id", "address", "doc_order").select(
        "chain_id", "address", "doc_order", F.posexplode("d.prices").alias("pos", "p")
    )
    return _hourly_last(points, "p.timestamp", "p.price", F.col("p.confidence"), PRICE_CHART)


def prices_fallback_current(raw: DataFrame) -> DataFrame:
    """Context: ``ts``."""
    items = _items(raw, "address:string,chain:struct<id:int>,priceUsd:double", "ts")
    return items.where("it.priceUsd is not null").select(
        "ts",
        F.col("it.chain.id").alias("chain_id"),
        F.lower("it.address").alias("token_address"),
        F.col("it.priceUsd").alias("price_usd"),
        F.lit(FALLBACK_CURRENT).alias("source"),
        _nothing("double").alias("confidence"),
    )


def prices_fallback_history(raw: DataFrame) -> DataFrame:
    """Context: ``chain_id``."""
    schema = "address string, historicalPriceUsd array<struct<x:double,y:double>>"
    points = _documents(_in_order(raw), schema, "chain_id", "doc_order").select(
        "chain_id", "doc_order", F.col("d.address").alias("address"), F.posexplode("d.historicalPriceUsd").alias("pos", "p")
    )
    return _hourly_last(points, "p.x", "p.y", _nothing("double"), FALLBACK_HISTORY)


# --- the rest ----------------------------------------------------------------


def yield_pools(raw: DataFrame, chains: list[str]) -> DataFrame:
    """Context: ``ts``. Only pools on the allowed chains."""
    pool = (
        "pool:string,chain:string,project:string,symbol:string,tvlUsd:double,apy:double,"
        "apyBase:double,apyReward:double"
    )
    pools = _documents(raw, f"data array<struct<{pool}>>", "ts").select("ts", F.explode("d.data").alias("p"))
    return pools.where(F.col("p.chain").isin(chains)).select(
        "ts",
        F.col("p.pool").alias("pool_id"),
        F.col("p.chain").alias("chain"),
        F.col("p.project").alias("project"),
        F.col("p.symbol").alias("symbol"),
        F.col("p.tvlUsd").alias("tvl_usd"),
        F.col("p.apy").alias("apy"),
        F.col("p.apyBase").alias("apy_base"),
        F.col("p.apyReward").alias("apy_reward"),
    )


def vault_v2_state(raw: DataFrame) -> DataFrame:
    """Context: ``ts``."""
    schema = (
        "address string, chain struct<id:int>, totalAssets string, idleAssets string, totalSupply string, "
        "sharePrice double, totalAssetsUsd double"
    )
    return _documents(raw, schema, "ts").select(
        "ts",
        F.col("d.chain.id").alias("chain_id"),
        F.lower("d.address").alias("vault"),
        _exact("d.totalAssets").alias("total_assets"),
        _exact("d.idleAssets").alias("idle_assets"),
        _exact("d.totalSupply").alias("total_supply"),
        F.col("d.sharePrice").alias("share_price"),
        F.col("d.totalAssetsUsd").alias("total_assets_usd"),
    )
