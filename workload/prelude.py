"""SQL twins of ``adapters.py`` as named common table expressions."""

from __future__ import annotations

CTES = {
    "market_state": """
        SELECT time_bucket(INTERVAL 300 SECONDS, ts) AS ts,
               CAST(user_id % 3 + 1 AS INTEGER) AS chain_id,
               'm' || user_id AS market_id,
               CAST(CAST(round((value + 1) * 1e8) AS BIGINT) AS DECIMAL(38,0)) AS total_supply_assets,
               CAST(CAST(round(least(value / 50.0, 1.0) * (value + 1) * 1e8) AS BIGINT) AS DECIMAL(38,0)) AS total_borrow_assets,
               CASE WHEN event_type = 'signup' AND value < 2 THEN NULL
                    ELSE CAST(CAST(round(value * 4e8) AS BIGINT) AS DECIMAL(38,0)) END AS rate_at_target,
               CASE WHEN event_type = 'error' AND value < 5 THEN NULL ELSE least(value / 50.0, 1.0) END AS utilization,
               CASE WHEN event_type = 'signup' AND value < 1 THEN 'n/a'
                    WHEN event_type <> 'click'
                    THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || repeat('0', 22) END AS oracle_price_raw,
               CASE WHEN event_type = 'error' THEN 'backfill' ELSE 'live' END AS source
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 300 SECONDS, ts)
                                   ORDER BY ts DESC, event_id DESC) = 1""",
    "markets": """
        SELECT CAST(c_custkey % 3 + 1 AS INTEGER) AS chain_id, 'm' || c_custkey AS market_id,
               CASE WHEN c_custkey % 13 = 0 THEN 'tokx' ELSE 'tok' || c_custkey % 5 END AS loan_token,
               CASE WHEN c_custkey % 13 = 0 THEN 'SYMX' WHEN c_custkey % 100 = 2 THEN 'SYM2B'
                    ELSE 'SYM' || c_custkey % 5 END AS loan_symbol,
               6 AS loan_decimals,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'tok' || 5 + c_custkey % 7 END AS collateral_token,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'COL' || 5 + c_custkey % 7 END AS collateral_symbol,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 18 END AS collateral_decimals,
               '0xo' || c_custkey AS oracle, '0xi' || c_custkey % 4 AS irm,
               CAST((700 + c_custkey % 250) || repeat('0', 15) AS DECIMAL(38,0)) AS lltv,
               TIMESTAMP '2023-06-01 00:00:00' AS creation_ts, c_acctbal > 0 AS listed,
               TIMESTAMP '2024-01-31 00:00:00' AS fetched_at
        FROM (SELECT * REPLACE (c_custkey + 3 AS c_custkey) FROM customer)""",
    "prices": """
        SELECT time_bucket(INTERVAL 900 SECONDS, ts) AS ts, CAST(user_id % 3 + 1 AS INTEGER) AS chain_id,
               'tok' || (user_id // 3) % 12 AS token_address, round(value / 25.0, 4) AS price_usd, 'llama' AS source,
               CASE WHEN event_id % 10 <> 0 THEN (event_id % 100) / 100.0 END AS confidence
        FROM events WHERE event_type = 'view'
        QUALIFY row_number() OVER (
            PARTITION BY user_id % 3, (user_id // 3) % 12, time_bucket(INTERVAL 900 SECONDS, ts)
            ORDER BY ts DESC, event_id DESC) = 1""",
    "prices_secondary": """
        SELECT time_bucket(INTERVAL 900 SECONDS, ts) AS ts, CAST(user_id % 3 + 1 AS INTEGER) AS chain_id,
               'tok' || (user_id // 3) % 12 AS token_address, round(value / 25.0, 4) AS price_usd, 'morpho' AS source,
               CAST(NULL AS DOUBLE) AS confidence
        FROM events WHERE event_type = 'purchase'
        QUALIFY row_number() OVER (
            PARTITION BY user_id % 3, (user_id // 3) % 12, time_bucket(INTERVAL 900 SECONDS, ts)
            ORDER BY ts DESC, event_id DESC) = 1""",
    "market_flows": """
        SELECT ts, CAST(user_id % 3 + 1 AS INTEGER) AS chain_id, 'm' || user_id AS market_id,
               CAST(event_id * 10 AS DECIMAL(38,0)) AS block_number, '0x' || event_id AS tx_hash,
               CAST(event_id % 7 AS INTEGER) AS log_index,
               CASE event_type
                    WHEN 'view' THEN CASE WHEN value < 10 THEN 'SupplyCollateral' ELSE 'Supply' END
                    WHEN 'click' THEN CASE WHEN value < 10 THEN 'WithdrawCollateral' ELSE 'Withdraw' END
                    WHEN 'signup' THEN 'Borrow' WHEN 'purchase' THEN 'Repay' ELSE 'Liquidation' END AS type,
               'u' || event_id % 97 AS account,
               CAST(CASE WHEN event_type = 'error' THEN NULL
                         WHEN event_type IN ('view', 'click') AND value < 10
                         THEN CAST(round(value * 100) AS BIGINT) || repeat('0', 16)
                         ELSE CAST(CAST(round(value * 1e6) AS BIGINT) AS VARCHAR) END AS DECIMAL(38,0)) AS assets,
               CASE WHEN event_type = 'error' THEN 'q' || event_id % 11 END AS liquidator,
               CASE WHEN event_type = 'error' THEN CAST(CAST(round(value * 1e6) AS BIGINT) AS DECIMAL(38,0)) END AS repaid_assets,
               CASE WHEN event_type = 'error'
                    THEN CAST(CAST(round(value * 100) AS BIGINT) || repeat('0', 16) AS DECIMAL(38,0)) END AS seized_assets,
               CASE WHEN event_type <> 'error' THEN NULL
                    WHEN value > 150 THEN CAST(CAST(round(value * 1e4) AS BIGINT) AS DECIMAL(38,0)) ELSE 0 END AS bad_debt_assets
        FROM events""",
    "book": """
        SELECT c_nationkey, o_custkey, date_trunc('month', o_orderdate) AS ts,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL""",
    "positions": """
        SELECT ts, CAST(c_nationkey % 3 + 1 AS INTEGER) AS chain_id, 'm' || c_nationkey AS market_id,
               'b' || o_custkey AS borrower, cents AS borrow_shares,
               CASE WHEN o_custkey % 17 <> 0 THEN cents END AS borrow_assets,
               CASE WHEN o_custkey % 19 <> 0 THEN 1.0 + (o_custkey % 50) / 100.0 END AS health_factor
        FROM book""",
    "supplier_positions": """
        SELECT ts, CAST(c_nationkey % 3 + 1 AS INTEGER) AS chain_id, 'm' || c_nationkey AS market_id,
               's' || o_custkey AS supplier, cents * 10 AS supply_shares, cents // 1000000 * 1000000 AS supply_assets
        FROM book""",
    "slots": """
        SELECT l_suppkey, date_trunc('month', l_shipdate) AS ts,
               CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END
                   + CASE l_linestatus WHEN 'O' THEN 0 ELSE 3 END AS slot,
               CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS q,
               CAST(sum(CAST(round(l_extendedprice) AS BIGINT)) AS BIGINT) AS p
        FROM lineitem GROUP BY ALL""",
    "vault_allocations": """
        SELECT ts, CAST(slot % 3 + 1 AS INTEGER) AS chain_id, '0xv' || l_suppkey AS vault, 'm' || slot AS market_id,
               q * 1000000 AS supply_assets, q * 1000 AS supply_shares,
               CASE WHEN slot = 5 THEN 0 ELSE p * 1000 END AS supply_cap, 'live' AS source
        FROM slots""",
    "bot_scores": """
        SELECT time_bucket(INTERVAL 60 SECONDS, ts) AS ts, CAST(user_id % 3 + 1 AS INTEGER) AS chain_id, '0xV' AS vault,
               't' || event_id AS tick_id, 'm' || user_id AS market_id
        FROM events WHERE event_type = 'purchase' AND user_id % 4 = 1
        QUALIFY row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 60 SECONDS, ts)
                                   ORDER BY ts DESC, event_id DESC) = 1""",
}
_NEEDS = {"positions": ["book"], "supplier_positions": ["book"], "vault_allocations": ["slots"]}


def with_tables(body: str, *names: str, **extra: str) -> str:
    """``body`` after the CTEs it reads, plus further named ones in order."""
    ordered: list[str] = []
    for name in names:
        for n in [*_NEEDS.get(name, []), name]:
            if n not in ordered:
                ordered.append(n)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
