"""Export panels, feeds and document elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.operators import newest
from statelake.plans import export

from .adapters import Given
from .prelude import with_tables
from .spec import Query
from .view_queries import (
    APY, FLOWS, FM, HEALTH, NETFLOW, ORACLE, REGIME, RETURNS, SD, SIX, SM, SMP, SPELL_HOLE, spells_sql,
)

REGIME_COLUMNS = [f"{m}_{w}" for m in ("avg_util", "pct_time_gt95", "pct_time_gt99") for w in ("7d", "30d")]

PANEL = f"""
    SELECT h.chain_id, h.market_id, h.ts, m.loan_symbol, m.collateral_symbol, CAST(m.lltv AS DOUBLE) / 1e18 AS lltv, h.u AS utilization,
           a.supply_apy, a.borrow_apy, h.apy_at_target, h.supply_usd, h.available_usd, h.is_broken, h.broken_reason,
           a.supply_apy - best.apy AS spread_to_best, s.oracle_h AS oracle_price, v.vol_7d_ann AS collateral_vol_7d,
           v.vol_30d_ann AS collateral_vol_30d, {', '.join(f'r.{c} / 100 AS {c}' for c in REGIME_COLUMNS)}, o.deviation AS oracle_deviation
    FROM health h
    JOIN (SELECT chain_id, market_id, max(ts) AS ts FROM market_state GROUP BY ALL
          HAVING max(ts) >= (SELECT max(ts) - INTERVAL 48 HOURS FROM market_state)) fresh USING (chain_id, market_id, ts)
    JOIN state_dim s USING (chain_id, market_id, ts)
    LEFT JOIN markets m USING (chain_id, market_id)
    LEFT JOIN apy a USING (chain_id, market_id, ts)
    LEFT JOIN (SELECT chain_id, ts, max(supply_apy) AS apy FROM apy JOIN health USING (chain_id, market_id, ts)
               WHERE NOT is_broken GROUP BY ALL) best USING (chain_id, ts)
    LEFT JOIN regime r USING (chain_id, market_id)
    LEFT JOIN (FROM returns QUALIFY ts = max(ts) OVER (PARTITION BY chain_id, token_address)) v
      ON v.chain_id = h.chain_id AND v.token_address = lower(m.collateral_token)
    LEFT JOIN checks o ON o.chain_id = h.chain_id AND o.market_id = h.market_id AND o.ts = h.ts"""
PANEL_CTES = {**SD, "apy": APY, "health": HEALTH, "regime": REGIME, "returns": RETURNS, "checks": ORACLE}
PANEL_DIGITS = SIX(
    "lltv", "utilization", "supply_apy", "borrow_apy", "apy_at_target", "supply_usd", "available_usd", "spread_to_best",
    "oracle_price", "collateral_vol_7d", "collateral_vol_30d", "oracle_deviation", *REGIME_COLUMNS,
)


def flow_tables(g: Given) -> dict[str, DataFrame]:
    return g.tables("market_flows", "markets", "prices", "market_state")


def health_elements(g: Given) -> DataFrame:
    """The nested document, flattened again for comparison."""
    t = g.tables("market_state", "markets", "prices", "positions", "supplier_positions")
    e = F.col("element")
    df = export.market_health_elements(t, newest(t["market_state"]))
    history = e["history"]
    return df.select(
        "chain_id", e["market_id"].alias("market_id"), e["ts"].alias("ts"), e["is_broken"].alias("is_broken"),
        e["broken_reason"].alias("broken_reason"), e["supply_apy"].alias("supply_apy"),
        e["utilization_regime"]["avg_util_7d"].alias("avg_util_7d"),
        e["borrower_risk"].isNull().alias("no_borrowers"), e["borrower_risk"]["borrowers"].cast("string").alias("borrowers"),
        e["borrower_risk"]["top3_debt_pct"].alias("top3_debt_pct"),
        e["supplier_concentration"]["top1_supplier"].alias("top1_supplier"),
        F.size(history).cast("bigint").alias("points"),
        F.try_element_at(history, F.lit(1))["ts"].alias("first_point"),
        F.try_element_at(history, F.lit(-1))["supply_apy"].alias("last_apy"),
    )


def flow_elements(g: Given) -> DataFrame:
    e = F.col("element")
    history = e["flow_history"]
    return export.market_flow_elements(flow_tables(g)).select(
        "chain_id", e["market_id"].alias("market_id"), e["net_supply_24h"].alias("net_supply_24h"),
        F.size(history).cast("bigint").alias("points"), F.try_element_at(history, F.lit(1))["ts"].alias("first_point"),
        F.aggregate(history, F.lit(0.0), lambda acc, p: acc + p["net_borrow_flow"]).alias("net_borrow"),
    )


def spell_lines(g: Given) -> DataFrame:
    """The lines of the document, parsed back: commas are between elements only."""
    spells = export.open_util_spells(g.tables("market_state"), max_hole_seconds=SPELL_HOLE)
    lines = export.separated(export.settle(export.spell_elements(spells, "peak_u")))
    text = F.regexp_replace("line", "^,", "")
    parsed = F.from_json(text, "market_id string, threshold double, start_ts string, end_ts string, duration_min bigint, peak_u double, open boolean")
    return lines.select((~F.startswith("line", F.lit(","))).alias("is_first"), parsed.alias("p")).select("is_first", "p.*")


ISO = "'%Y-%m-%dT%H:%M:%SZ'"
OPEN_SPELLS = """
    SELECT {columns}, end_ts >= mine - INTERVAL 2 HOURS AS open
    FROM spells JOIN (SELECT chain_id, market_id, max(ts) AS mine FROM {samples} GROUP BY ALL) USING (chain_id, market_id)
    WHERE end_ts >= (SELECT max(ts) - INTERVAL 30 DAYS FROM {samples})"""
UTIL_SPELLS = spells_sql("market_state", "utilization", (0.92, 0.95), 72, "max(utilization) AS peak_u")
DEPEG_SPELLS = spells_sql(
    "(FROM checks WHERE deviation IS NOT NULL)", "abs(deviation)", (0.02, 0.05), 72,
    "max(abs(deviation)) AS peak_abs_deviation, first(deviation ORDER BY abs(deviation) DESC, ts) AS peak_deviation")
SPELL_COLUMNS = "chain_id, market_id, threshold, start_ts, end_ts, duration_min"
WINDOWS = ", ".join(
    f"""sum(if(ts >= top - INTERVAL {span}, greatest(ifnull(supply_flow, 0), 0), 0)) AS supply_in_{n},
        sum(if(ts >= top - INTERVAL {span}, greatest(-ifnull(supply_flow, 0), 0), 0)) AS supply_out_{n},
        sum(if(ts >= top - INTERVAL {span}, ifnull(supply_flow, 0), 0)) AS net_supply_{n},
        sum(if(ts >= top - INTERVAL {span}, ifnull(borrow_flow, 0), 0)) AS net_borrow_{n}"""
    for n, span in (("24h", "24 HOURS"), ("7d", "7 DAYS"))
)
TOP = "(SELECT max(ts) AS top FROM market_flows)"
SUMMARY = f"""
    SELECT chain_id, market_id, any_value(loan_symbol) AS loan_symbol, {WINDOWS}, count(*) FILTER (type = 'Liquidation') AS n_liquidations_30d
    FROM flows, {TOP} WHERE ts >= top - INTERVAL 30 DAYS GROUP BY chain_id, market_id"""
SPARK_LINE = """
    SELECT chain_id, market_id, ts, supply_apy, u FROM apy
    WHERE minute(ts) = 0 AND ts >= (SELECT max(ts) - INTERVAL 7 DAYS FROM apy)"""

EXPORT_QUERIES = [
    Query("export_latest_panel", lambda g: export.latest_market_panel(
        {**g.tables("market_state", "markets", "prices")}, newest(g.table("market_state"))),
        with_tables(PANEL, *SMP, **PANEL_CTES), PANEL_DIGITS),
    Query(
        "export_borrower_risk", lambda g: export.borrower_risk(g.tables("positions", "markets")),
        with_tables("""
            SELECT chain_id, market_id, count(*) AS borrowers, min(health_factor) AS min_hf,
                   count(*) FILTER (health_factor < 1.05) AS borrowers_hf_lt_105,
                   ifnull(sum(borrow_assets) FILTER (health_factor < 1.05), 0) / nullif(sum(borrow_assets), 0) AS pct_debt_hf_lt_105,
                   sum(borrow_assets) FILTER (place <= 3) / nullif(sum(borrow_assets), 0) AS top3_debt_pct
            FROM (FROM positions QUALIFY ts = max(ts) OVER (PARTITION BY market_id))
            JOIN (SELECT market_id, borrower, row_number() OVER (PARTITION BY market_id ORDER BY borrow_assets DESC NULLS LAST) AS place
                  FROM (FROM positions QUALIFY ts = max(ts) OVER (PARTITION BY market_id))) USING (market_id, borrower)
            GROUP BY ALL""", "positions"),
        SIX("min_hf", "pct_debt_hf_lt_105", "top3_debt_pct"),
    ),
    Query(
        "export_lender_concentration", lambda g: export.lender_concentration(g.tables("supplier_positions", "markets")),
        with_tables("""
            SELECT chain_id, market_id, count(*) AS suppliers, any_value(supplier) FILTER (place = 1) AS top1_supplier,
                   sum(supply_assets) FILTER (place = 1) / nullif(sum(supply_assets), 0) AS top1_supply_pct,
                   sum(supply_assets) FILTER (place <= 3) / nullif(sum(supply_assets), 0) AS top3_supply_pct
            FROM (SELECT *, row_number() OVER (PARTITION BY market_id ORDER BY supply_assets DESC, supplier) AS place
                  FROM (FROM supplier_positions QUALIFY ts = max(ts) OVER (PARTITION BY market_id)))
            GROUP BY ALL""", "supplier_positions"),
        SIX("top1_supply_pct", "top3_supply_pct"),
    ),
    Query(
        "export_flow_summary", lambda g: export.flow_summary(flow_tables(g)), with_tables(SUMMARY, *FM, flows=FLOWS),
        {f"{c}_{w}": 4 for c in ("supply_in", "supply_out", "net_supply", "net_borrow") for w in ("24h", "7d")},
    ),
    Query(
        "export_flow_history", lambda g: export.flow_history(flow_tables(g)),
        with_tables(f"""SELECT chain_id, market_id, ts, net_supply_flow, net_borrow_flow FROM netflow, {TOP} WHERE ts >= top - INTERVAL 7 DAYS""",
                    *FM, flows=FLOWS, netflow=NETFLOW),
        {"net_supply_flow": 4, "net_borrow_flow": 4},
    ),
    Query(
        "export_whale_feed", lambda g: export.whale_feed(flow_tables(g)),
        with_tables(f"""
            SELECT ts, chain_id, market_id, loan_symbol, tx_hash, type, account, flow, abs(flow) / supply AS pct_of_supply
            FROM (SELECT f.*, coalesce(borrow_flow, supply_flow) AS flow, CAST(s.total_supply_assets AS DOUBLE) / 1e6 AS supply
                  FROM (FROM flows WHERE loan_symbol IS NOT NULL) f ASOF JOIN market_state s
                    ON s.chain_id = f.chain_id AND s.market_id = f.market_id AND f.ts >= s.ts), {TOP}
            WHERE supply > 0 AND abs(flow) >= 0.05 * supply AND ts >= top - INTERVAL 14 DAYS""", *FM, "market_state", flows=FLOWS),
        SIX("flow", "pct_of_supply"),
    ),
    Query(
        "export_liquidation_feed", lambda g: export.liquidation_feed(flow_tables(g)),
        with_tables(f"""
            SELECT f.ts, f.chain_id, f.market_id, loan_symbol, nullif(collateral_symbol, 'IDLE') AS collateral_symbol, tx_hash, account AS borrower,
                   liquidator, repaid_assets, seized_assets, bad_debt_assets, repaid_assets * l.price_usd AS repaid_usd,
                   seized_assets * c.price_usd AS seized_usd
            FROM (SELECT flows.* FROM flows, {TOP} WHERE type = 'Liquidation' AND ts >= top - INTERVAL 30 DAYS) f
            ASOF LEFT JOIN prices l ON l.chain_id = f.chain_id AND l.token_address = lower(f.loan_token) AND f.ts >= l.ts
            ASOF LEFT JOIN prices c ON c.chain_id = f.chain_id AND c.token_address = lower(f.collateral_token) AND f.ts >= c.ts""",
            *FM, "prices", flows=FLOWS),
        SIX("repaid_assets", "seized_assets", "bad_debt_assets", "repaid_usd", "seized_usd"),
    ),
    Query(
        "export_depeg_spells", lambda g: export.open_depeg_spells(g.tables("market_state", "markets", "prices"), max_hole_seconds=SPELL_HOLE),
        with_tables(OPEN_SPELLS.format(columns=SPELL_COLUMNS + ", peak_abs_deviation, peak_deviation", samples="checks"),
                    *SMP, **SD, checks=ORACLE, spells=DEPEG_SPELLS),
        SIX("threshold", "peak_abs_deviation", "peak_deviation"),
    ),
    Query(
        "export_util_spells", lambda g: export.open_util_spells(g.tables("market_state"), max_hole_seconds=SPELL_HOLE),
        with_tables(OPEN_SPELLS.format(columns=SPELL_COLUMNS + ", peak_u", samples="market_state"), "market_state", spells=UTIL_SPELLS),
        SIX("threshold", "peak_u"),
    ),
    Query(
        "export_sparkline", lambda g: export.sparkline(g.tables("market_state")), with_tables(SPARK_LINE, "market_state", apy=APY),
        SIX("supply_apy", "u"),
    ),
    Query(
        "export_health_document", health_elements,
        with_tables(f"""
            SELECT p.chain_id, p.market_id, strftime(p.ts, {ISO}) AS ts, is_broken, broken_reason, p.supply_apy, avg_util_7d,
                   borrowers IS NULL AS no_borrowers, CAST(borrowers AS VARCHAR) AS borrowers, top3_debt_pct, top1_supplier,
                   ifnull(points, 0) AS points, first_point, last_apy
            FROM panel p
            LEFT JOIN (SELECT chain_id, market_id, count(*) AS points, strftime(min(ts), {ISO}) AS first_point, arg_max(supply_apy, ts) AS last_apy
                       FROM line GROUP BY ALL) USING (chain_id, market_id)
            LEFT JOIN (SELECT chain_id, market_id, count(*) AS borrowers, sum(borrow_assets) FILTER (place <= 3) / nullif(sum(borrow_assets), 0) AS top3_debt_pct
                       FROM (SELECT *, row_number() OVER (PARTITION BY market_id ORDER BY borrow_assets DESC NULLS LAST) AS place
                             FROM (FROM positions QUALIFY ts = max(ts) OVER (PARTITION BY market_id))) GROUP BY ALL) USING (chain_id, market_id)
            LEFT JOIN (SELECT chain_id, market_id, first(supplier ORDER BY supply_assets DESC, supplier) AS top1_supplier
                       FROM (FROM supplier_positions QUALIFY ts = max(ts) OVER (PARTITION BY market_id)) GROUP BY ALL) USING (chain_id, market_id)""",
            *SMP, "positions", "supplier_positions", **PANEL_CTES, line=SPARK_LINE, panel=PANEL),
        SIX("supply_apy", "avg_util_7d", "top3_debt_pct", "last_apy"),
    ),
    Query(
        "export_flow_document", flow_elements,
        with_tables(f"""
            SELECT s.chain_id, s.market_id, net_supply_24h, ifnull(points, 0) AS points, first_point, ifnull(net_borrow, 0) AS net_borrow
            FROM ({SUMMARY}) s LEFT JOIN (
                SELECT chain_id, market_id, count(*) AS points, strftime(min(ts), {ISO}) AS first_point, sum(net_borrow_flow) AS net_borrow
                FROM netflow, {TOP} WHERE ts >= top - INTERVAL 7 DAYS GROUP BY ALL) USING (chain_id, market_id)""", *FM, flows=FLOWS, netflow=NETFLOW),
        {"net_supply_24h": 4, "net_borrow": 4},
    ),
    Query(
        "export_spell_document", spell_lines,
        with_tables(f"""
            SELECT row_number() OVER (ORDER BY end_ts DESC, chain_id, market_id, threshold, start_ts) = 1 AS is_first, market_id, threshold,
                   strftime(start_ts, {ISO}) AS start_ts, strftime(end_ts, {ISO}) AS end_ts, duration_min, peak_u, open
            FROM ({OPEN_SPELLS.format(columns=SPELL_COLUMNS + ', peak_u', samples='market_state')})""", "market_state", spells=UTIL_SPELLS),
        SIX("threshold", "peak_u"),
    ),
]
