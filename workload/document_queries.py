"""The exported documents, written and read back: every field of headers and elements."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statelake.operators import newest
from statelake.plans.export import run_export
from statelake.session import shared_dir

from .adapters import Given
from .export_queries import (
    EXPORT_QUERIES, ISO, OPEN_SPELLS, PANEL, PANEL_CTES, REGIME_COLUMNS, SPARK_LINE, SPELL_COLUMNS, SUMMARY, TOP, flow_tables,
)
from .prelude import with_tables
from .source_queries import dense, dense_tables
from .spec import Query
from .view_queries import FLOWS, FM, NETFLOW, ORACLE, SIX, SMP, spells_sql

_SQL = {q.name: q for q in EXPORT_QUERIES}

HEADER = "schema_version int, generated_at string, chain_id int"
REGIME_KIND = ", ".join(f"{c}: double" for c in REGIME_COLUMNS)
HEALTH = (
    "market_id: string, loan_symbol: string, collateral_symbol: string, lltv: double, ts: string, utilization: double, supply_apy: double, borrow_apy: double, "
    "apy_at_target: double, supply_usd: double, available_usd: double, is_broken: boolean, broken_reason: string, spread_to_best: double, oracle_price: double, "
    f"collateral_vol_7d: double, collateral_vol_30d: double, utilization_regime: struct<{REGIME_KIND}>, oracle_deviation: double, "
    "borrower_risk: struct<borrowers: bigint, min_hf: double, borrowers_hf_lt_105: bigint, pct_debt_hf_lt_105: double, top3_debt_pct: double>, "
    "supplier_concentration: struct<suppliers: bigint, top1_supplier: string, top1_supply_pct: double, top3_supply_pct: double>, "
    "history: array<struct<ts: string, supply_apy: double, u: double>>"
)
FLOW_NUMBERS = [f"{c}_{w}" for w in ("24h", "7d") for c in ("supply_in", "supply_out", "net_supply", "net_borrow")]
FLOW_MARKETS = (
    "market_id: string, loan_symbol: string, " + ", ".join(f"{c}: double" for c in FLOW_NUMBERS)
    + ", n_liquidations_30d: bigint, flow_history: array<struct<ts: string, net_supply_flow: double, net_borrow_flow: double>>"
)
WHALES = "ts: string, market_id: string, loan_symbol: string, tx_hash: string, type: string, account: string, flow: double, pct_of_supply: double"
LIQUIDATIONS = (
    "ts: string, market_id: string, loan_symbol: string, collateral_symbol: string, tx_hash: string, borrower: string, liquidator: string, "
    "repaid_assets: double, seized_assets: double, bad_debt_assets: double, repaid_usd: double, seized_usd: double"
)
FLOW_HEADER_KIND = f"{HEADER}, data_through string, synced boolean"
FLOW_LISTS = {"markets": f"struct<{FLOW_MARKETS}>", "whale_flows": f"struct<{WHALES}>", "liquidations": f"struct<{LIQUIDATIONS}>"}
SPELL = "market_id: string, threshold: double, start_ts: string, end_ts: string, duration_min: bigint"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """block, id and value of each line of a text file that several tasks read: blocks by their
    first byte, within a block the ids follow the lines."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")


def elements_of(spark: SparkSession, path: str, header: str, name: str, kind: str) -> DataFrame:
    """The header's fields, ``place`` from 1 and ``e`` of each element of a document's list.

    A document has its header, each mark and each element on a line of its own, so its lines are
    parsed apart from each other. A line's number is its place in its block plus the lines of
    the blocks before it; the table of blocks has a row for every split of the file.
    """
    lines = lines_of(spark, path)
    ids_of = lambda mark: F.array_sort(F.collect_list(F.when(F.col("value") == mark, F.col("id"))))
    blocks = lines.groupBy("block").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.min_by("value", "id").alias("head"),
        ids_of(f',"{name}":[').alias("opened"), ids_of("]").alias("closed"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    numbers = lambda ids: F.flatten(F.collect_list(F.transform(ids, lambda i: i + F.col("shift"))).over(everywhere))
    strict = {"mode": "FAILFAST"}
    blocks = blocks.withColumn("shift", shift).select(
        "block", "shift", F.from_json(F.concat(F.first("head").over(everywhere), F.lit("}")), header, strict).alias("h"),
        F.array_min(numbers("opened")).alias("opened"), numbers("closed").alias("closed"),
    ).withColumn("closed", F.array_min(F.filter("closed", lambda i: i > F.col("opened"))))
    inside = lines.join(F.broadcast(blocks), "block").withColumn("row", F.col("id") + F.col("shift")).where("row > opened AND row < closed")
    return inside.select("h.*", (F.col("row") - F.col("opened")).alias("place"), F.from_json(F.ltrim("value", F.lit(",")), kind, strict).alias("e"))


def read_back(g: Given, tables: dict[str, DataFrame], table: str, name: str, header: str, elements: str, kind: str) -> DataFrame:
    """A list of a document of the given tables, as of the newest row of one of them."""
    folder = f"{shared_dir(g.spark)}/documents-{uuid.uuid4().hex}"
    as_of = tables[table].select(newest(tables[table])).first()[0]
    run_export(g.spark, tables, folder, as_of, only=[name])
    return elements_of(g.spark, f"{folder}/{name}", header, elements, kind)


def flattened(df: DataFrame, *header: str) -> DataFrame:
    """One row per element: the header's fields, the element's place from 1 and its fields, blocks' fields beside them."""
    fields: list[Column] = []
    for f in df.schema["e"].dataType:
        if f.dataType.typeName() == "struct":
            fields += [F.col(f"e.{f.name}.{inner}").alias(inner) for inner in f.dataType.fieldNames()]
        else:
            fields.append(F.col(f"e.{f.name}").alias(f.name))
    return df.select("schema_version", "generated_at", F.col("chain_id").alias("header_chain"), *header, F.col("place").cast("bigint").alias("place"), *fields)


def points(df: DataFrame, history: str) -> DataFrame:
    """One row per point of an element's history (one without any has one row), instead of the element's place."""
    opened = df.withColumn("_point", F.explode_outer(history)).drop(history, "place")
    values = opened.schema["_point"].dataType.fieldNames()
    return opened.select(*[c for c in opened.columns if c != "_point"], *[F.col(f"_point.{v}").alias(f"point_{v}") for v in values])


def health_document(g: Given) -> DataFrame:
    t = g.tables("market_state", "markets", "prices", "positions", "supplier_positions")
    document = read_back(g, t, "market_state", "market_health.json", HEADER, "markets", f"struct<{HEALTH}>")
    return points(flattened(document), "history")


def flow_document(g: Given, elements: str) -> DataFrame:
    document = read_back(g, flow_tables(g), "market_flows", "market_flows.json", FLOW_HEADER_KIND, elements, FLOW_LISTS[elements])
    return flattened(document, "data_through", "synced")


def spell_document(g: Given, name: str, *numbers: str) -> DataFrame:
    kind = f"{SPELL}, {', '.join(f'{n}: double' for n in numbers)}, open: boolean"
    t = dense(g)
    return flattened(read_back(g, t, "market_state", name, HEADER, "spells", f"struct<{kind}>"))


def header_sql(as_of: str, chains: str, more: str = "") -> str:
    return f"""3 AS schema_version, (SELECT strftime(max(ts), {ISO}) FROM {as_of}) AS generated_at,
               (SELECT CASE WHEN count(DISTINCT chain_id) = 1 THEN min(chain_id) END FROM {chains}) AS header_chain{more}"""


BOOK_SQL = "FROM {0} QUALIFY ts = max(ts) OVER (PARTITION BY chain_id, market_id)"
HEALTH_SQL = f"""
    SELECT {header_sql('market_state', 'panel')}, p.* EXCLUDE (chain_id, ts), strftime(p.ts, {ISO}) AS ts,
           b.* EXCLUDE (chain_id, market_id), s.* EXCLUDE (chain_id, market_id),
           strftime(l.ts, {ISO}) AS point_ts, l.supply_apy AS point_supply_apy, l.u AS point_u
    FROM panel p
    LEFT JOIN line l ON l.chain_id = p.chain_id AND l.market_id = p.market_id
    LEFT JOIN (SELECT chain_id, market_id, count(*) AS borrowers, min(health_factor) AS min_hf, count(*) FILTER (health_factor < 1.05) AS borrowers_hf_lt_105,
                      ifnull(sum(borrow_assets) FILTER (health_factor < 1.05), 0) / nullif(sum(borrow_assets), 0) AS pct_debt_hf_lt_105,
                      sum(borrow_assets) FILTER (place <= 3) / nullif(sum(borrow_assets), 0) AS top3_debt_pct
               FROM (SELECT *, row_number() OVER (PARTITION BY chain_id, market_id ORDER BY borrow_assets DESC NULLS LAST) AS place
                     FROM ({BOOK_SQL.format('positions')})) GROUP BY ALL) b ON b.chain_id = p.chain_id AND b.market_id = p.market_id
    LEFT JOIN (SELECT chain_id, market_id, count(*) AS suppliers, first(supplier ORDER BY supply_assets DESC, supplier) AS top1_supplier,
                      sum(supply_assets) FILTER (place = 1) / nullif(sum(supply_assets), 0) AS top1_supply_pct,
                      sum(supply_assets) FILTER (place <= 3) / nullif(sum(supply_assets), 0) AS top3_supply_pct
               FROM (SELECT *, row_number() OVER (PARTITION BY chain_id, market_id ORDER BY supply_assets DESC, supplier) AS place
                     FROM ({BOOK_SQL.format('supplier_positions')})) GROUP BY ALL) s ON s.chain_id = p.chain_id AND s.market_id = p.market_id"""
FLOW_HEADER = header_sql("market_flows", "summary", f", (SELECT strftime(max(ts), {ISO}) FROM market_flows) AS data_through, true AS synced")
FEED = "row_number() OVER (ORDER BY ts DESC, tx_hash) AS place"


def _body(name: str, head: str) -> str:
    """The body of a query's SQL, without the tables it names first."""
    return head + _SQL[name].sql.rsplit(head, 1)[1]


def spells_document_sql(samples: str, values: str, spells: str, **extra: str) -> str:
    listed = OPEN_SPELLS.format(columns=f"{SPELL_COLUMNS}, {values}", samples=samples)
    return dense_tables(f"""
        SELECT {header_sql('market_state', 'found')}, row_number() OVER (ORDER BY end_ts DESC, chain_id, market_id, threshold, start_ts) AS place,
               market_id, threshold, strftime(start_ts, {ISO}) AS start_ts, strftime(end_ts, {ISO}) AS end_ts, duration_min, {values}, open
        FROM found""", **extra, spells=spells, found=listed)


DOCUMENT_QUERIES = [
    Query(
        "document_market_health", health_document,
        with_tables(HEALTH_SQL, *SMP, "positions", "supplier_positions", **PANEL_CTES, line=SPARK_LINE, panel=PANEL),
        {**_SQL["export_latest_panel"].digits, **SIX("min_hf", "pct_debt_hf_lt_105", "top3_debt_pct", "top1_supply_pct", "top3_supply_pct", "point_supply_apy", "point_u")},
    ),
    Query(
        "document_market_flows", lambda g: points(flow_document(g, "markets"), "flow_history"),
        with_tables(f"""
            SELECT {FLOW_HEADER}, s.* EXCLUDE (chain_id), strftime(h.ts, {ISO}) AS point_ts, h.net_supply_flow AS point_net_supply_flow,
                   h.net_borrow_flow AS point_net_borrow_flow
            FROM summary s LEFT JOIN (SELECT n.* FROM netflow n, {TOP} WHERE ts >= top - INTERVAL 7 DAYS) h
              ON h.chain_id = s.chain_id AND h.market_id = s.market_id""", *FM, flows=FLOWS, netflow=NETFLOW, summary=SUMMARY),
        {**{c: 4 for c in FLOW_NUMBERS}, "point_net_supply_flow": 4, "point_net_borrow_flow": 4},
    ),
    Query(
        "document_whale_flows", lambda g: flow_document(g, "whale_flows"),
        with_tables(f"""SELECT {FLOW_HEADER}, {FEED}, w.* EXCLUDE (chain_id, ts), strftime(ts, {ISO}) AS ts FROM whales w""",
                    *FM, "market_state", flows=FLOWS, summary=SUMMARY,
                    whales=_body("export_whale_feed", "SELECT ts, chain_id, market_id, loan_symbol, tx_hash")),
        SIX("flow", "pct_of_supply"),
    ),
    Query(
        "document_liquidations", lambda g: flow_document(g, "liquidations"),
        with_tables(f"""SELECT {FLOW_HEADER}, {FEED}, w.* EXCLUDE (chain_id, ts), strftime(ts, {ISO}) AS ts FROM feed w""",
                    *FM, "prices", flows=FLOWS, summary=SUMMARY,
                    feed=_body("export_liquidation_feed", "SELECT f.ts, f.chain_id")),
        SIX("repaid_assets", "seized_assets", "bad_debt_assets", "repaid_usd", "seized_usd"),
    ),
    Query(
        "document_util_spells", lambda g: spell_document(g, "util_spells.json", "peak_u"),
        spells_document_sql("market_state", "peak_u", spells_sql("market_state", "utilization", (0.92, 0.95), 2, "max(utilization) AS peak_u")),
        SIX("threshold", "peak_u"),
    ),
    Query(
        "document_depeg_spells", lambda g: spell_document(g, "depeg_spells.json", "peak_abs_deviation", "peak_deviation"),
        spells_document_sql(
            "checks", "peak_abs_deviation, peak_deviation",
            spells_sql("(FROM checks WHERE deviation IS NOT NULL)", "abs(deviation)", (0.02, 0.05), 2,
                       "max(abs(deviation)) AS peak_abs_deviation, first(deviation ORDER BY abs(deviation) DESC, ts) AS peak_deviation"), checks=ORACLE),
        SIX("threshold", "peak_abs_deviation", "peak_deviation"),
    ),
]
