"""Stored-table merges, selection, kernels, read API, quality report and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.functions import floor_to
from statelake.operators import (
    above_floor, asof_join, heal_candidates, latch, latest_rows, newest, not_covered, share_within,
    threshold_runs, throughout, top_k_sum, tracked_set, tracked_tokens, with_fallback, with_leader_spread,
)
from statelake.plans import quality
from statelake.plans.reader import Reader
from statelake.session import shared_dir
from statelake.sources import Lake, resume_from
from statelake.sources.store import coerce, merge_rows, missing_rows
from statelake.streaming import deduplicated, hourly_net_flow, keyed_merge, last_in_bucket, online_latch, start_merge
from statelake.tables import MARKET_FLOWS, MARKETS, PRICES, TABLES, TableSpec

from .adapters import GIVEN_SCHEMAS, Given, chain, market
from .prelude import with_tables
from .spec import Query
from .view_queries import FLOWS, FM, NAMED, NETFLOW, SD, SIX, SM

# --- stored tables -----------------------------------------------------------


def orders_current(g: Given) -> DataFrame:
    return g.raw("orders").where("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", "o_totalprice")


def orders_batch(g: Given) -> DataFrame:
    """Overlaps the current rows; every key appears twice, the second time later."""
    rows = g.raw("orders").where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), "o_totalprice")
    first = rows.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("n", F.lit(1))
    return first.unionByName(rows.withColumn("o_totalprice", F.col("o_totalprice") * 3).withColumn("n", F.lit(2)))


def upsert(g: Given) -> DataFrame:
    current = orders_current(g).withColumn("n", F.lit(0))
    return merge_rows(current, orders_batch(g), ["o_orderkey"], F.col("n")).drop("n")


def insert_missing(g: Given) -> DataFrame:
    current = orders_current(g).withColumn("n", F.lit(0))
    return missing_rows(current, orders_batch(g), ["o_orderkey"], F.col("n")).drop("n")


def fresh_lake(g: Given) -> Lake:
    return Lake(g.spark, f"{shared_dir(g.spark)}/lake-{uuid.uuid4().hex}")


def stored_prices(g: Given) -> DataFrame:
    """Written, replaced where the second source has the key, healed, read back whole."""
    lake = fresh_lake(g)
    first, second = g.prices(), g.prices_secondary()
    lake.upsert(PRICES, first.where("ts < timestamp '2024-01-20 00:00:00'"))
    lake.upsert(PRICES, second.where("ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-22 00:00:00'"))
    lake.insert_missing(PRICES, first)
    return lake.scan(PRICES).select("ts", "chain_id", "token_address", "price_usd", "source")


def stored_dimension(g: Given) -> DataFrame:
    """The dimension, half of it written twice with another symbol."""
    lake = fresh_lake(g)
    lake.upsert(MARKETS, g.markets())
    lake.upsert(MARKETS, g.markets().where("loan_token = 'tok1'").withColumn("loan_symbol", F.lit("NEW")))
    return lake.scan(MARKETS).select("chain_id", "market_id", "loan_symbol", "loan_token")


def resumed(g: Given) -> DataFrame:
    flows = g.table("market_flows")
    stored = flows.where("ts < timestamp '2024-01-15 00:00:00' and chain_id <> 3")
    return resume_from(flows, stored, first_since="2024-01-25 00:00:00").select("tx_hash", "log_index", "ts", "chain_id")


def coerced(g: Given) -> DataFrame:
    """Text amounts cast, missing columns NULL, an unknown column dropped."""
    raw = g.events().select(
        "ts", F.lit("999").alias("chain_id"), F.concat(F.lit("t"), "user_id").alias("token_address"),
        F.col("value").cast("string").alias("price_usd"), F.col("props").alias("unknown"),
    )
    return coerce(raw, PRICES)


# --- selection ---------------------------------------------------------------


def universe(g: Given) -> DataFrame:
    return g.raw("customer").select(
        chain(F.col("c_custkey")), market(F.col("c_custkey")), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("supply_usd")
    )


def tracked(g: Given) -> DataFrame:
    extras = g.table("markets").where("loan_token = 'tokx'")
    return tracked_set(g.table("vault_allocations"), extras, universe(g), 5000.0)


UNIVERSE = """
    SELECT CAST(c_custkey % 3 + 1 AS INTEGER) AS chain_id, 'm' || c_custkey AS market_id,
           CASE WHEN c_acctbal > 0 THEN c_acctbal END AS supply_usd
    FROM customer"""
TRACKED = """
    SELECT chain_id, market_id FROM vault_allocations UNION SELECT chain_id, market_id FROM markets WHERE loan_token = 'tokx'
    UNION SELECT chain_id, market_id FROM universe WHERE supply_usd >= 5000"""


def fallback(g: Given) -> DataFrame:
    keys = ["chain_id", "token_address", "ts"]
    return with_fallback(g.table("prices"), coerce(g.prices_secondary(), PRICES), keys)


def healed(g: Given) -> DataFrame:
    """Hourly history of the second source fills what the first one lacks."""
    as_of = F.lit("2024-01-25 00:00:00").cast("timestamp")
    keys = ["chain_id", "token_address", "ts"]
    history = heal_candidates(coerce(g.prices_secondary(), PRICES), as_of, 72)
    return missing_rows(g.table("prices"), history, keys, F.col("price_usd")).select(*keys, "price_usd", "source")


# --- kernels -----------------------------------------------------------------


def plain_asof(g: Given, **options) -> DataFrame:
    ev = g.events()
    views = ev.where("event_type = 'view'").withColumnRenamed("event_id", "view_id")
    clicks = ev.where("event_type = 'click'").select("event_id", "ts", "user_id", "value")
    return asof_join(
        clicks, views, [("user_id", "user_id")], {"value": "view_value", "view_id": "view_id"}, tie_break=["view_id"], **options
    )


ASOF = """
    SELECT c.event_id, c.ts, c.user_id, c.value, v.value AS view_value, v.event_id AS view_id
    FROM (FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (FROM events WHERE event_type = 'view') v
      ON v.user_id = c.user_id AND c.ts >= v.ts"""


# Ordered kernels run on the clock-sampled panel: an entity has one row per
# cadence bucket there, which bounds its series by the time span.
MARKET = ["chain_id", "market_id"]


def panel_runs(g: Given) -> DataFrame:
    panel = g.table("market_state").select(*MARKET, "ts", "utilization")
    runs = threshold_runs(panel, MARKET, F.col("utilization"), [0.92, 0.95], 72 * 3600)
    return runs.groupBy(*MARKET, "threshold", "run_id").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n")
    ).drop("run_id")


def _levels(g: Given) -> DataFrame:
    return g.table("market_state").select(*MARKET, "ts", F.unix_micros("ts").alias("_t"), F.col("utilization").alias("u"))


def latched(g: Given) -> DataFrame:
    event = F.when(F.col("u") > 0.98, 1).when(F.col("u") < 0.2, 0)
    return _levels(g).select(*MARKET, "ts", latch(event, MARKET).alias("inside"))


def dwelling(g: Given) -> DataFrame:
    held = throughout(F.col("u") < 0.99, MARKET, 72, 24)
    return _levels(g).select(*MARKET, "ts", held.alias("held"))


def top_customers(g: Given) -> DataFrame:
    orders = g.raw("orders").select("o_orderpriority", "o_totalprice")
    return top_k_sum(orders, ["o_orderpriority"], "o_totalprice", 3, "top3")


def leader_spread(g: Given) -> DataFrame:
    rows = g.raw("lineitem").groupBy("l_suppkey", F.col("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("q"))
    return with_leader_spread(rows, "spread", "q", F.col("q") < 40, ["day"]).select("l_suppkey", "day", "spread")


# --- read API ----------------------------------------------------------------


def reader(g: Given, *names: str) -> Reader:
    return Reader(g.spark, g.tables(*names))


STATE_VIEW = """
    SELECT ts, chain_id, market_id, loan_symbol, collateral_symbol, CAST(lltv AS DOUBLE) / 1e18 AS lltv, supply_h AS supply_assets,
           CAST(total_borrow_assets AS DOUBLE) / pow(10, loan_decimals) AS borrow_assets, free_h AS liquidity, utilization,
           CAST(rate_at_target AS DOUBLE) / 1e18 AS rate_at_target_per_sec, target_apy AS apy_at_target, oracle_h AS oracle_price, source
    FROM (SELECT * REPLACE (if(loan_decimals IS NULL, NULL, supply_h) AS supply_h, if(loan_decimals IS NULL, NULL, free_h) AS free_h) FROM state_dim)"""
STATE_DIGITS = {
    **SIX("lltv", "supply_assets", "borrow_assets", "liquidity", "utilization", "apy_at_target", "oracle_price"),
    "rate_at_target_per_sec": 16,
}

# --- streams -----------------------------------------------------------------


def stream_of(g: Given, name: str) -> DataFrame:
    """A given table as a file stream, with a UTC event time."""
    source = g.spark.readStream.schema(GIVEN_SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet").parquet(g.dir)
    return source.withColumn("ts", F.col("ts").cast("timestamp"))


class StreamGiven(Given):
    """The adapted event tape, fed by the stream."""

    def events(self) -> DataFrame:
        return stream_of(self, "events")


def run_to_table(g: Given, stream: DataFrame, name: str) -> DataFrame:
    """Runs a stream over what is available and reads back what it wrote."""
    base = f"{shared_dir(g.spark)}/stream-{name}-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return g.spark.read.schema(stream.schema).parquet(f"{base}/out")


def streamed_flows(g: Given) -> DataFrame:
    live = StreamGiven(g.spark, g.dir)
    flows = coerce_stream(live.market_flows())
    # Every event is delivered twice.
    twice = flows.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return run_to_table(g, deduplicated(twice).select("tx_hash", "log_index", "ts", "type"), "flows")


def coerce_stream(df: DataFrame) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in MARKET_FLOWS.schema])


def streamed_netflow(g: Given) -> DataFrame:
    live = StreamGiven(g.spark, g.dir)
    return run_to_table(g, hourly_net_flow(coerce_stream(live.market_flows()), g.table("markets")), "netflow")


def streamed_merge(g: Given) -> DataFrame:
    """The tape merged into day partitions by micro-batches, twice; the second run changes nothing."""
    lake, base = fresh_lake(g), f"{shared_dir(g.spark)}/merge-{uuid.uuid4().hex}"
    live = StreamGiven(g.spark, g.dir)
    for attempt in range(2):
        start_merge(live.market_flows(), lake, MARKET_FLOWS, f"{base}/{attempt}", F.col("block_number")).awaitTermination()
    return lake.scan(MARKET_FLOWS).select("date", "tx_hash", "log_index", "type").withColumn("date", F.col("date").cast("string"))


def streamed_buckets(g: Given) -> DataFrame:
    """Newest sample per entity and 900 s bucket, for buckets the watermark has closed."""
    samples = stream_of(g, "events").select("user_id", "ts", "value", "event_id")
    return run_to_table(g, last_in_bucket(samples, ["user_id"], 900, tie=["event_id"]), "buckets")


LATCHES = TableSpec("latches", "user_id exact, inside flag, since ts, held flag", ("user_id",), partitioned=False)


def streamed_latch(g: Given) -> DataFrame:
    """Changed states of each micro-batch are merged into a stored table, one row per entity."""
    lake, base = fresh_lake(g), f"{shared_dir(g.spark)}/latch-{uuid.uuid4().hex}"
    event = F.when(F.col("value") > 80, 1).when(F.col("value") < 10, 0)
    states = online_latch(stream_of(g, "events"), ["user_id"], event, F.col("event_id"), dwell_seconds=6 * 3600)
    query = (
        states.writeStream.outputMode("update").foreachBatch(keyed_merge(lake, LATCHES, F.col("expired"), base))
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return lake.scan(LATCHES).select(F.col("user_id").cast("long").alias("user_id"), "inside", F.col("since").cast("string").alias("since"), "held")


# --- registration ------------------------------------------------------------

OPERATOR_QUERIES = [
    Query(
        "store_upsert", upsert,
        """SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_totalprice * 3 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0
           UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 <> 0""",
        {"o_totalprice": 4},
    ),
    Query(
        "store_insert_missing", insert_missing,
        "SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 6 = 0",
        {"o_totalprice": 4},
    ),
    Query(
        "store_round_trip", stored_prices,
        with_tables("""
            SELECT DISTINCT ON (chain_id, token_address, ts) ts, chain_id, token_address, price_usd, source
            FROM (SELECT *, 1 AS choice FROM prices_secondary WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-22'
                  UNION ALL SELECT *, 2 FROM prices)
            ORDER BY chain_id, token_address, ts, choice""", "prices", "prices_secondary"),
        {"price_usd": 6},
    ),
    Query(
        "store_dimension", stored_dimension,
        with_tables("SELECT chain_id, market_id, if(loan_token = 'tok1', 'NEW', loan_symbol) AS loan_symbol, loan_token FROM markets", "markets"),
    ),
    Query(
        "store_coerce", coerced,
        """SELECT ts, 999 AS chain_id, 't' || user_id AS token_address, value AS price_usd, CAST(NULL AS VARCHAR) AS source,
                  CAST(NULL AS DOUBLE) AS confidence FROM events""", {"price_usd": 6, "confidence": 6},
    ),
    Query(
        "resume_from_stored", resumed,
        with_tables("""
            SELECT tx_hash, log_index, ts, f.chain_id FROM market_flows f
            WHERE ts >= ifnull((SELECT max(s.ts) - INTERVAL 1 HOUR FROM market_flows s
                                WHERE s.chain_id = f.chain_id AND s.chain_id <> 3 AND s.ts < TIMESTAMP '2024-01-15'),
                               TIMESTAMP '2024-01-25')""", "market_flows"),
    ),
    Query("tracked_set", tracked, with_tables(TRACKED, "vault_allocations", "markets", universe=UNIVERSE)),
    Query(
        "above_floor", lambda g: above_floor(g.table("markets").select("chain_id", "market_id"), universe(g), 5000.0),
        with_tables("""
            SELECT chain_id, market_id FROM markets m
            WHERE NOT EXISTS (SELECT 1 FROM universe u WHERE u.market_id = m.market_id AND ifnull(supply_usd, 0) < 5000)""",
            "markets", universe=UNIVERSE),
    ),
    Query(
        "tracked_tokens", lambda g: tracked_tokens(g.table("markets")),
        with_tables("""SELECT chain_id, loan_token AS token_address FROM markets UNION
                       SELECT chain_id, collateral_token FROM markets WHERE collateral_token IS NOT NULL""", "markets"),
    ),
    Query(
        "price_fallback", fallback,
        with_tables("""
            SELECT ts, chain_id, token_address, price_usd, source, confidence FROM prices p
            WHERE confidence >= 0.8 OR NOT EXISTS (SELECT 1 FROM prices_secondary s WHERE s.chain_id = p.chain_id
                                                   AND s.token_address = p.token_address AND s.ts = p.ts)
            UNION ALL
            SELECT ts, chain_id, token_address, price_usd, source, confidence FROM prices_secondary s
            WHERE NOT EXISTS (SELECT 1 FROM prices p WHERE p.chain_id = s.chain_id AND p.token_address = s.token_address
                              AND p.ts = s.ts AND p.confidence >= 0.8)""", "prices", "prices_secondary"),
        SIX("price_usd", "confidence"),
    ),
    Query(
        "not_covered", lambda g: not_covered(tracked(g), g.table("market_state").select("chain_id", "market_id")),
        with_tables(f"""SELECT * FROM ({TRACKED}) t WHERE NOT EXISTS (
                          SELECT 1 FROM market_state s WHERE s.chain_id = t.chain_id AND s.market_id = t.market_id)""",
                    "vault_allocations", "markets", "market_state", universe=UNIVERSE),
    ),
    Query(
        "heal_missing", healed,
        with_tables("""
            SELECT chain_id, token_address, ts, price_usd, source FROM prices_secondary s
            WHERE ts BETWEEN TIMESTAMP '2024-01-22' AND TIMESTAMP '2024-01-25' AND NOT EXISTS (
                SELECT 1 FROM prices p WHERE p.chain_id = s.chain_id AND p.token_address = s.token_address AND p.ts = s.ts)""",
            "prices", "prices_secondary"),
        {"price_usd": 6},
    ),
    Query("asof_join", plain_asof, ASOF, {"value": 6, "view_value": 6}),
    Query("asof_join_split", lambda g: plain_asof(g, chunk_seconds=3600, max_rows=1), ASOF, {"value": 6, "view_value": 6}),
    Query(
        "latest_rows", lambda g: latest_rows(g.events().select("user_id", "event_type", "ts", "value"), ["user_id", "event_type"]),
        "SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY ALL", {"value": 6},
    ),
    Query(
        "threshold_runs", panel_runs,
        with_tables("""
            SELECT chain_id, market_id, threshold, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n
            FROM (SELECT *, count(*) FILTER (breaks) OVER (PARTITION BY threshold, chain_id, market_id ORDER BY ts) AS island
                  FROM (SELECT chain_id, market_id, ts, threshold, coalesce(utilization >= threshold, false) AS inside,
                               NOT inside OR coalesce(lag(ts) OVER w < ts - INTERVAL 72 HOURS, true) AS breaks
                        FROM market_state, (SELECT unnest([0.92, 0.95]) AS threshold)
                        WINDOW w AS (PARTITION BY threshold, chain_id, market_id ORDER BY ts)))
            WHERE inside GROUP BY threshold, chain_id, market_id, island""", "market_state"), {"threshold": 4},
    ),
    Query(
        "hysteresis_latch", latched,
        with_tables("""
            SELECT chain_id, market_id, ts,
                   coalesce(last_value(CASE WHEN utilization > 0.98 THEN 1 WHEN utilization < 0.2 THEN 0 END IGNORE NULLS)
                            OVER (PARTITION BY chain_id, market_id ORDER BY ts ROWS UNBOUNDED PRECEDING), 0) = 1 AS inside
            FROM market_state""", "market_state"),
    ),
    Query(
        "dwell_test", dwelling,
        with_tables("""
            SELECT chain_id, market_id, ts,
                   count(*) FILTER (utilization >= 0.99 OR utilization IS NULL) OVER w = 0 AND ts - min(ts) OVER w >= INTERVAL 24 HOURS AS held
            FROM market_state
            WINDOW w AS (PARTITION BY chain_id, market_id ORDER BY ts RANGE BETWEEN INTERVAL 72 HOURS PRECEDING AND CURRENT ROW)""",
            "market_state"),
    ),
    Query(
        "share_within",
        lambda g: share_within(g.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_orderkey"], "l_quantity", "pct"),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
                  100.0 * l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) AS pct FROM lineitem""",
        {"l_quantity": 4, "pct": 6},
    ),
    Query(
        "top_k_sum", top_customers,
        """SELECT o_orderpriority, sum(o_totalprice) AS top3 FROM (
             SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS n FROM orders)
           WHERE n <= 3 GROUP BY ALL""", {"top3": 4},
    ),
    Query(
        "leader_spread", leader_spread,
        """SELECT l_suppkey, day, q - max(q) FILTER (q < 40) OVER (PARTITION BY day) AS spread
           FROM (SELECT l_suppkey, l_shipdate AS day, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)""", {"spread": 4},
    ),
    Query(
        "read_market_state",
        lambda g: reader(g, *SM).market_state(loan="SYM1", collateral="COL5", since="2024-01-10 00:00:00"),
        with_tables(f"SELECT * FROM ({STATE_VIEW}) WHERE loan_symbol = 'SYM1' AND collateral_symbol = 'COL5' AND ts >= TIMESTAMP '2024-01-10'", *SM, **SD),
        STATE_DIGITS,
    ),
    Query(
        "read_market_state_latest", lambda g: reader(g, *SM).market_state_latest(),
        with_tables(f"SELECT * FROM ({STATE_VIEW}) QUALIFY ts = max(ts) OVER (PARTITION BY chain_id, market_id)", *SM, **SD), STATE_DIGITS,
    ),
    Query(
        "read_liquidity_risk", lambda g: reader(g, *SM).liquidity_risk().select("chain_id", "market_id", "hours_observed", "pct_time_gt99"),
        with_tables("""SELECT chain_id, market_id, count(*) AS hours_observed, 100.0 * avg(if(utilization > 0.99, 1, 0)) AS pct_time_gt99
                       FROM state_dim GROUP BY ALL""", *SM, **SD), {"pct_time_gt99": 6},
    ),
    Query(
        "read_vault_snapshot", lambda g: reader(g, "vault_allocations", "markets").vault_snapshot("0xV7").select("vault", "ts", "market_id", "weight_pct"),
        with_tables("""SELECT vault, ts, market_id, 100.0 * supply_assets / sum(supply_assets) OVER (PARTITION BY vault) AS weight_pct
                       FROM (FROM vault_allocations WHERE vault = '0xv7' QUALIFY rank() OVER (PARTITION BY vault ORDER BY ts DESC) = 1)""",
                    "vault_allocations"), {"weight_pct": 6},
    ),
    Query(
        "read_vault_allocations",
        lambda g: reader(g, "vault_allocations", "markets").vault_allocations("0xV7", since="1998-01-01 00:00:00").select("ts", "vault", "market_id", "supply_assets"),
        with_tables("""SELECT ts, vault, v.market_id, v.supply_assets / pow(10, loan_decimals) AS supply_assets
                       FROM vault_allocations v LEFT JOIN markets d ON d.chain_id = v.chain_id AND d.market_id = v.market_id
                       WHERE vault = '0xv7' AND ts >= TIMESTAMP '1998-01-01'""", "vault_allocations", "markets"), {"supply_assets": 6},
    ),
    Query(
        "read_prices", lambda g: reader(g, "prices", "markets").prices(symbol="SYM1", since="2024-01-10 00:00:00"),
        with_tables(f"SELECT * FROM ({NAMED}) WHERE symbol = 'SYM1' AND ts >= TIMESTAMP '2024-01-10'", "prices", "markets"),
        SIX("price_usd", "confidence"),
    ),
    Query(
        "read_positions", lambda g: reader(g, "positions", "markets").positions("m3").select("ts", "market_id", "borrower", "borrow_shares"),
        with_tables("SELECT ts, market_id, borrower, borrow_shares FROM positions WHERE market_id = 'm3'", "positions"), exact=("borrow_shares",),
    ),
    Query(
        "read_sql_parameters",
        lambda g: reader(g, *FM).sql("SELECT type, count(*) AS n FROM v_market_flows WHERE chain_id = ? AND ts >= ? GROUP BY type", [2, "2024-01-10"]),
        with_tables("SELECT type, count(*) AS n FROM market_flows WHERE chain_id = 2 AND ts >= TIMESTAMP '2024-01-10' GROUP BY ALL", "market_flows"),
    ),
    Query(
        "quality_null_rates", lambda g: quality.null_rates(g.table("market_state")),
        with_tables("""
            UNPIVOT (SELECT avg(if(ts IS NULL, 1.0, 0.0)) AS ts, avg(if(chain_id IS NULL, 1.0, 0.0)) AS chain_id, avg(if(market_id IS NULL, 1.0, 0.0)) AS market_id,
                            avg(if(rate_at_target IS NULL, 1.0, 0.0)) AS rate_at_target, avg(if(utilization IS NULL, 1.0, 0.0)) AS utilization,
                            avg(if(oracle_price_raw IS NULL, 1.0, 0.0)) AS oracle_price_raw,
                            avg(if(total_supply_assets IS NULL, 1.0, 0.0)) AS total_supply_assets, avg(if(total_borrow_assets IS NULL, 1.0, 0.0)) AS total_borrow_assets,
                            avg(if(source IS NULL, 1.0, 0.0)) AS source, (SELECT avg(if(value IS NULL, 1.0, 0.0)) FROM events) AS total_supply_shares,
                            (SELECT avg(if(value IS NULL, 1.0, 0.0)) FROM events) AS total_borrow_shares,
                            (SELECT avg(if(ts IS NULL, 1.0, 0.0)) FROM events) AS api_timestamp FROM market_state)
            ON COLUMNS(*) INTO NAME column_name VALUE null_rate""", "market_state").replace("UNPIVOT (", "SELECT * FROM (UNPIVOT (").replace(
            "VALUE null_rate", "VALUE null_rate) WHERE null_rate > 0"),
        {"null_rate": 8},
    ),
    Query(
        "quality_row_counts", lambda g: quality.column_profile(g.table("market_state")).select("column_name", "n_rows"),
        with_tables("""
            SELECT unnest(['ts', 'chain_id', 'market_id', 'total_supply_assets', 'total_supply_shares', 'total_borrow_assets', 'total_borrow_shares',
                           'rate_at_target', 'utilization', 'oracle_price_raw', 'api_timestamp', 'source']) AS column_name, count(*) AS n_rows
            FROM market_state""", "market_state"),
    ),
    Query(
        "quality_gaps", lambda g: quality.bucket_gaps(g.table("market_state"), ["chain_id", "market_id"], 3600),
        with_tables("""
            SELECT chain_id, market_id, strftime(min(ts), '%Y-%m-%d') AS first_ts, strftime(max(ts), '%Y-%m-%d') AS last_ts,
                   1 + date_diff('hour', date_trunc('hour', min(ts)), date_trunc('hour', max(ts))) AS expected,
                   count(DISTINCT date_trunc('hour', ts)) AS actual
            FROM market_state GROUP BY chain_id, market_id HAVING expected > actual""", "market_state"),
    ),
    Query(
        "quality_missing_buckets", lambda g: quality.missing_buckets(g.table("prices"), ["chain_id", "token_address"], 3600),
        with_tables("""
            SELECT chain_id, token_address, ts FROM (
                SELECT chain_id, token_address, unnest(span) AS ts
                FROM (SELECT chain_id, token_address, generate_series(min(h), max(h), INTERVAL 1 HOUR) AS span FROM hours GROUP BY ALL)) s
            WHERE NOT EXISTS (SELECT 1 FROM hours x WHERE x.chain_id = s.chain_id AND x.token_address = s.token_address AND x.h = s.ts)""",
            "prices", hours="SELECT DISTINCT chain_id, token_address, date_trunc('hour', ts) AS h FROM prices"),
    ),
    Query(
        "stream_deduplicated", streamed_flows,
        with_tables("SELECT tx_hash, log_index, ts, type FROM market_flows", "market_flows"),
    ),
    Query(
        "stream_net_flow", streamed_netflow,
        with_tables("SELECT * FROM netflow WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM market_flows)", *FM, flows=FLOWS, netflow=NETFLOW),
        {n: 4 for n in ("supply_in", "supply_out", "net_supply_flow", "borrow_in", "borrow_out", "net_borrow_flow")},
    ),
    Query(
        "stream_keyed_merge", streamed_merge,
        with_tables("SELECT strftime(ts, '%Y-%m-%d') AS date, tx_hash, log_index, type FROM market_flows", "market_flows"),
    ),
    Query(
        "stream_last_in_bucket", streamed_buckets,
        """SELECT time_bucket(INTERVAL 900 SECONDS, ts) AS ts, user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS event_id
           FROM events GROUP BY time_bucket(INTERVAL 900 SECONDS, ts), user_id
           HAVING time_bucket(INTERVAL 900 SECONDS, min(ts)) + INTERVAL 900 SECONDS <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        {"value": 6},
    ),
    Query(
        "stream_latch", streamed_latch,
        """WITH marks AS (SELECT user_id, ts, event_id, CASE WHEN value > 80 THEN 1 WHEN value < 10 THEN 0 END AS mark FROM events),
                ends AS (SELECT user_id, max(ts) FILTER (mark = 0) AS left_at, coalesce(max(ts) FILTER (mark = 1), TIMESTAMP '1970-01-01') > coalesce(left_at, TIMESTAMP '1970-01-01') AS inside
                         FROM marks GROUP BY user_id),
                spells AS (SELECT e.user_id, any_value(inside) AS inside, min(ts) FILTER (mark = 1 AND inside AND (left_at IS NULL OR ts > left_at)) AS began
                           FROM ends e JOIN marks m ON m.user_id = e.user_id GROUP BY e.user_id)
           SELECT user_id, inside, rtrim(rtrim(strftime(began, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS since,
                  inside AND began + INTERVAL 6 HOURS <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events) AS held FROM spells""",
    ),
]
