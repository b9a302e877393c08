"""Snapshot documents: panels, feeds and nested JSON.

Panels are DataFrames with one row per element of a document. Documents are
written element by element in their order, by several tasks, so no document is ever
one row or one task's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.functions import iso_utc, wad, text_price
from statelake.session import shared_dir
from statelake.operators import ago, count_where, instants, latest_rows, newest, since, sum_where, with_leader_spread

from .book_views import v_position_risk, v_supplier_concentration
from .catalog import buildable
from .flow_views import LIQUIDATION, v_liquidations, v_market_flows, v_market_netflow, v_whale_flows
from .market_views import (
    MARKET, Tables, apy_columns, health_panel, oracle_deviation, oracle_samples, v_market_apy, v_utilization_regime,
)
from .price_views import TOKEN, token_returns
from .spell_views import deviation_spells, utilization_spells, v_oracle_price_check

# Document version, look-backs of the documents, freshness limits.
SCHEMA_VERSION = 3
FRESH_HOURS = 48
SPARKLINE_DAYS, FLOW_HISTORY_DAYS = 7, 7
WHALE_DAYS, LIQUIDATION_DAYS, SPELL_DAYS = 14, 30, 30
OPEN_HOURS, SYNCED_HOURS = 2, 2

_REGIME = [f"{m}_{w}" for m in ("avg_util", "pct_time_gt95", "pct_time_gt99") for w in ("7d", "30d")]


# --- panels ------------------------------------------------------------------


def latest_market_panel(t: Tables, as_of: Column | None = None) -> DataFrame:
    """One row per market heard from in the last 48 h before the newest sample.

    Health, APY, spread and oracle price all derive from one pass over the state
    samples; only each market's newest row meets the other tables.
    """
    # Peers of one instant are all inside the cut, so it leaves the spread as it is.
    panel = health_panel(t, ago(newest(newest_source(t, "market_state")), hours=FRESH_HOURS))
    newest_rows = latest_rows(rated_columns(panel), MARKET)
    # One row per market: no group can be large.
    checked = oracle_deviation(newest_rows.withColumnRenamed("_loan_token", "loan_token"), t["prices"], max_rows=None)
    regime = v_utilization_regime(t, as_of).select(*MARKET, *[(F.col(c) / 100.0).alias(c) for c in _REGIME])
    volatility = latest_rows(token_returns(t), TOKEN).select(
        "chain_id", F.col("token_address").alias("_collateral"),
        F.col("vol_7d_ann").alias("collateral_vol_7d"), F.col("vol_30d_ann").alias("collateral_vol_30d"),
    )
    has_oracle = F.col("oracle_price_raw").isNotNull() & F.col("collateral_token").isNotNull()
    return (
        checked.withColumn("_collateral", F.lower("collateral_token"))
        .join(regime, MARKET, "left")
        .join(volatility, ["chain_id", "_collateral"], "left")
        .select(
            *MARKET, "ts", "loan_symbol", "collateral_symbol", wad("lltv").alias("lltv"),
            F.col("u").alias("utilization"), "supply_apy", "borrow_apy", "apy_at_target", "supply_usd",
            "available_usd", "is_broken", "broken_reason", "spread_to_best",
            text_price("oracle_price_raw", "loan_decimals", "collateral_decimals").alias("oracle_price"),
            "collateral_vol_7d", "collateral_vol_30d", *_REGIME,
            F.when(has_oracle, F.col("deviation")).alias("oracle_deviation"),
        )
    )


def rated_columns(panel: DataFrame) -> DataFrame:
    """APY and spread columns that are NULL where rate or utilization is unknown."""
    df = apy_columns(panel)
    known = F.col("_target").isNotNull() & F.col("u").isNotNull()
    for c in ("borrow_rate_per_sec", "borrow_apy", "supply_apy"):
        df = df.withColumn(c, F.when(known, F.col(c)))
    return with_leader_spread(df, "spread_to_best", "supply_apy", ~F.col("is_broken"), ["chain_id", "ts"])


def borrower_risk(t: Tables) -> DataFrame:
    return v_position_risk(t).select(
        *MARKET, "borrowers", "min_hf", "borrowers_hf_lt_105",
        (F.col("pct_debt_hf_lt_105") / 100.0).alias("pct_debt_hf_lt_105"),
        (F.col("top3_debt_pct") / 100.0).alias("top3_debt_pct"),
    )


def lender_concentration(t: Tables) -> DataFrame:
    return v_supplier_concentration(t).select(
        *MARKET, "suppliers", "top1_supplier",
        (F.col("top1_supply_pct") / 100.0).alias("top1_supply_pct"),
        (F.col("top3_supply_pct") / 100.0).alias("top3_supply_pct"),
    )


def recent_tape(t: Tables, anchor: Column, days: int) -> Tables:
    """The tables with the event tape cut to the look-back before anything is joined."""
    return {**t, "market_flows": since(t["market_flows"], ago(anchor, days=days))}


def flow_summary(t: Tables) -> DataFrame:
    """Gross and net flow per market over windows that end at the newest event."""
    anchor = newest(newest_source(t, "market_flows"))
    ts, s, b = F.col("ts"), F.col("supply_flow"), F.col("borrow_flow")
    recent = v_market_flows(recent_tape(t, anchor, LIQUIDATION_DAYS))
    aggs = [F.any_value("loan_symbol", ignoreNulls=True).alias("loan_symbol")]
    for label, start in (("24h", ago(anchor, hours=24)), ("7d", ago(anchor, days=7))):
        inside = ts >= start
        aggs += [
            sum_where(s, inside & (s > 0)).alias(f"supply_in_{label}"),
            sum_where(-s, inside & (s < 0)).alias(f"supply_out_{label}"),
            sum_where(s, inside).alias(f"net_supply_{label}"),
            sum_where(b, inside).alias(f"net_borrow_{label}"),
        ]
    aggs.append(count_where(F.col("type") == LIQUIDATION).alias("n_liquidations_30d"))
    return recent.groupBy(*MARKET).agg(*aggs)


def flow_history(t: Tables) -> DataFrame:
    anchor = newest(newest_source(t, "market_flows"))
    # An hour is listed when it starts inside the look-back, so its events do too.
    tape = recent_tape(t, anchor, FLOW_HISTORY_DAYS)
    df = v_market_netflow(tape).where(F.col("ts") >= ago(anchor, days=FLOW_HISTORY_DAYS))
    return df.select(*MARKET, "ts", "net_supply_flow", "net_borrow_flow")


def whale_feed(t: Tables) -> DataFrame:
    anchor = newest(newest_source(t, "market_flows"))
    return v_whale_flows(recent_tape(t, anchor, WHALE_DAYS)).select(
        "ts", *MARKET, "loan_symbol", "tx_hash", "type", "account", "flow",
        (F.col("pct_of_supply") / 100.0).alias("pct_of_supply"),
    )


def liquidation_feed(t: Tables) -> DataFrame:
    anchor = newest(newest_source(t, "market_flows"))
    return v_liquidations(recent_tape(t, anchor, LIQUIDATION_DAYS)).select(
        "ts", *MARKET, "loan_symbol", "collateral_symbol", "tx_hash", "borrower", "liquidator",
        "repaid_assets", "seized_assets", "bad_debt_assets", "repaid_usd", "seized_usd",
    )


def with_open_flag(spells: DataFrame, samples: DataFrame) -> DataFrame:
    """Spells of the last 30 days; ``open`` when the market's newest sample is at
    most two hours past the spell's end."""
    per_market = samples.groupBy(*MARKET).agg(F.max("ts").alias("_newest"))
    recent = spells.where(F.col("end_ts") >= ago(newest(samples), days=SPELL_DAYS))
    joined = recent.join(per_market, MARKET)
    return joined.withColumn("open", F.col("end_ts") >= ago(F.col("_newest"), hours=OPEN_HOURS)).drop("_newest")


def open_util_spells(t: Tables, **options) -> DataFrame:
    spells = with_open_flag(utilization_spells(t["market_state"], **options), t["market_state"])
    return spells.drop("min_available_liquidity")


def open_depeg_spells(t: Tables, **options) -> DataFrame:
    # The lookups keep every row, so the newest instants come from the rows before them.
    return with_open_flag(deviation_spells(v_oracle_price_check(t), **options), oracle_samples(t))


def sparkline(t: Tables) -> DataFrame:
    """On-the-hour APY and utilization of the last 7 days."""
    start = ago(newest(t["market_state"].where("rate_at_target is not null and utilization is not null")), days=SPARKLINE_DAYS)
    recent = v_market_apy({"market_state": since(t["market_state"], start)}).where(F.minute("ts") == 0)
    return recent.select(*MARKET, "ts", "supply_apy", "u")


# --- elements ----------------------------------------------------------------


def _number(c: str) -> Column:
    """JSON has no NaN or infinity."""
    v = F.col(c).cast("double")
    bad = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(~bad, v).alias(c)


def place(*order: Column | str) -> Column:
    """Where an element stands in its document: ascending, no two alike."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[c.alias(f"p{i}") for i, c in enumerate(cols)]).alias("place")


def _history(points: DataFrame, name: str, *values: str) -> DataFrame:
    """Points nested per market, oldest first (at most one per hour of the look-back)."""
    point = F.struct(F.col("ts").alias("_at"), iso_utc("ts").alias("ts"), *[_number(v) for v in values])
    sorted_points = F.array_sort(F.collect_list(point))
    return points.groupBy(*MARKET).agg(
        F.transform(sorted_points, lambda p: F.struct(p["ts"].alias("ts"), *[p[v].alias(v) for v in values])).alias(name)
    )


def _or_empty(column: str, like: DataFrame) -> Column:
    kind = like.schema[column].dataType
    return F.coalesce(F.col(column), F.array().cast(kind)).alias(column)


def market_health_elements(t: Tables, as_of: Column | None = None) -> DataFrame:
    """One nested element per market; keys are always present, blocks without data are NULL."""
    df = latest_market_panel(t, as_of)
    if "positions" in t:
        df = df.join(borrower_risk(t), MARKET, "left")
    if "supplier_positions" in t:
        df = df.join(lender_concentration(t), MARKET, "left")
    history = _history(sparkline(t), "history", "supply_apy", "u")
    df = df.join(history, MARKET, "left")

    def block(marker: str, fields: Sequence[str], kinds: Mapping[str, str]) -> Column:
        if marker not in df.columns:
            empty = F.struct(*[F.lit(None).cast(kinds.get(f, "double")).alias(f) for f in fields])
            return F.when(F.lit(False), empty)
        body = F.struct(*[F.col(f) if f in kinds else _number(f) for f in fields])
        return F.when(F.col(marker).isNotNull(), body)

    risk = ["borrowers", "min_hf", "borrowers_hf_lt_105", "pct_debt_hf_lt_105", "top3_debt_pct"]
    lenders = ["suppliers", "top1_supplier", "top1_supply_pct", "top3_supply_pct"]
    numbers = ["supply_apy", "borrow_apy", "apy_at_target", "supply_usd", "available_usd"]
    after = ["spread_to_best", "oracle_price", "collateral_vol_7d", "collateral_vol_30d"]
    return df.select(
        "chain_id",
        place("is_broken", F.col("supply_usd").isNull(), -F.col("supply_usd"), "chain_id", "market_id"),
        F.struct(
            "market_id", "loan_symbol", "collateral_symbol", _number("lltv"), iso_utc("ts").alias("ts"),
            _number("utilization"), *[_number(c) for c in numbers], "is_broken", "broken_reason",
            *[_number(c) for c in after],
            F.struct(*[_number(c) for c in _REGIME]).alias("utilization_regime"),
            _number("oracle_deviation"),
            block("borrowers", risk, {"borrowers": "bigint", "borrowers_hf_lt_105": "bigint"}).alias("borrower_risk"),
            block("suppliers", lenders, {"suppliers": "bigint", "top1_supplier": "string"}).alias(
                "supplier_concentration"
            ),
            _or_empty("history", history),
        ).alias("element"),
    )


def market_flow_elements(t: Tables) -> DataFrame:
    summary = flow_summary(t)
    history = _history(flow_history(t), "flow_history", "net_supply_flow", "net_borrow_flow")
    numbers = [c for c in summary.columns if c[-3:] in ("24h", "_7d") and c != "n_liquidations_30d"]
    return summary.join(history, MARKET, "left").select(
        "chain_id",
        place(-F.abs("net_supply_24h"), "chain_id", "market_id"),
        F.struct(
            "market_id", "loan_symbol", *[_number(c) for c in numbers], "n_liquidations_30d",
            _or_empty("flow_history", history),
        ).alias("element"),
    )


def feed_elements(feed: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Newest first."""
    return feed.select(
        "chain_id",
        place(-F.unix_micros("ts"), "tx_hash", F.xxhash64(*feed.columns)),
        F.struct(
            iso_utc("ts").alias("ts"), "market_id", *[F.col(c) for c in texts], *[_number(c) for c in numbers]
        ).alias("element"),
    )


def whale_elements(t: Tables) -> DataFrame:
    return feed_elements(whale_feed(t), ["loan_symbol", "tx_hash", "type", "account"], ["flow", "pct_of_supply"])


def liquidation_elements(t: Tables) -> DataFrame:
    texts = ["loan_symbol", "collateral_symbol", "tx_hash", "borrower", "liquidator"]
    numbers = ["repaid_assets", "seized_assets", "bad_debt_assets", "repaid_usd", "seized_usd"]
    return feed_elements(liquidation_feed(t), texts, numbers)


def spell_elements(spells: DataFrame, *numbers: str) -> DataFrame:
    return spells.select(
        "chain_id",
        place(-F.unix_micros("end_ts"), "chain_id", "market_id", "threshold", "start_ts"),
        F.struct(
            "market_id", _number("threshold"), iso_utc("start_ts").alias("start_ts"),
            iso_utc("end_ts").alias("end_ts"), "duration_min", *[_number(c) for c in numbers], "open",
        ).alias("element"),
    )


def newest_source(t: Tables, name: str) -> DataFrame:
    """What has the newest instant of a table: its named instants, or all its rows."""
    known = instants(t, name)
    return t[name] if known is None else known[0]


# --- documents ---------------------------------------------------------------


def settle(elements: DataFrame) -> DataFrame:
    """(chain_id, place, line): elements computed once, kept as a table in the
    shared folder. What follows reads them several times."""
    spark = elements.sparkSession
    path = f"{shared_dir(spark)}/elements-{uuid.uuid4().hex}"
    body = F.to_json("element", {"ignoreNullFields": "false"}).alias("line")
    df = elements.select("chain_id", "place", body)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sole_chain(df: DataFrame) -> DataFrame:
    """One row: the only chain present, NULL when there is none or more than one."""
    lo, hi = F.min("chain_id"), F.max("chain_id")
    return df.agg(F.when(lo == hi, lo).alias("chain_id"))


def separated(lines: DataFrame) -> DataFrame:
    """Puts a comma before every line but that of the smallest place."""
    first = lines.select(F.min("place")).scalar()
    comma = F.when(F.col("place") == first, F.lit("")).otherwise(F.lit(","))
    return lines.withColumn("line", F.concat(comma, "line"))


def write_document(path: str, header: DataFrame, lists: Mapping[str, DataFrame], joined: bool = True) -> None:
    """Writes one JSON document: the header's fields, then each list of settled lines.

    Lines are dealt by ranges of their order and written by as many tasks; the parts' bytes, one
    part after the other, are the document. ``joined`` puts them into the single file the
    format asks for, which appears under its name when it is whole; otherwise they stay
    in the folder ``<path>.parts``, whose ``_parts.json`` lists their names in order and their sizes.
    """
    spark = header.sparkSession

    def fixed(part: int, line: Column) -> DataFrame:
        return spark.range(1).select(F.lit(part).alias("part"), F.lit(0).cast("bigint").alias("row"), line.alias("line"))

    fields = F.regexp_replace(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), r"\}$", "")
    text = header.select(F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("row"), fields.alias("line"))
    part = 0
    for name, lines in lists.items():
        # A sorted list numbers its lines in order, whatever partition they sit in.
        body = separated(lines).orderBy("place").select(
            F.lit(part + 2).alias("part"), F.monotonically_increasing_id().alias("row"), "line"
        )
        text = (
            text.unionByName(fixed(part + 1, F.lit(f',"{name}":[')))
            .unionByName(body)
            .unionByName(fixed(part + 3, F.lit("]")))
        )
        part += 3
    text = text.unionByName(fixed(part + 1, F.lit("}")))
    staging = f"{path}.staging"
    text.orderBy("part", "row").select("line").write.mode("overwrite").text(staging)
    _publish(spark, staging, path, joined)


def _publish(spark: SparkSession, staging: str, path: str, joined: bool) -> None:
    """Renames what was written over its final name: readers see the old or the new document."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staging), hadoop.Path(path if joined else f"{path}.parts")
    conf = spark._jsc.hadoopConfiguration()
    fs = source.getFileSystem(conf)
    # Part files are named in the order of their ranges.
    parts = sorted((s.getPath().getName(), s.getLen()) for s in fs.globStatus(hadoop.Path(f"{staging}/part-*")) if s.getLen())
    if joined and len(parts) == 1:
        whole = hadoop.Path(source, parts[0][0])
    elif joined:
        whole = hadoop.Path(source, "whole")
        out = fs.create(whole)
        try:
            for name, _ in parts:
                piece = fs.open(hadoop.Path(source, name))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, out, 1 << 20, False)
                finally:
                    piece.close()
        finally:
            out.close()
    else:
        out = fs.create(hadoop.Path(source, "_parts.json"))
        try:
            out.write(bytearray(json.dumps([{"name": name, "bytes": size} for name, size in parts]).encode()))
        finally:
            out.close()
        fs.delete(target, True)
        whole = source
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(whole), fs.makeQualified(target), how)
    fs.delete(source, True)


def run_export(
    spark: SparkSession, tables: Tables, folder: str, generated_at: datetime, only: Sequence[str] | None = None, joined: bool = True
) -> list[str]:
    """Writes every document the present tables allow, or ``only`` those of the names given; returns their names."""
    have = {v.name for v in buildable(tables)}
    stamp = F.lit(generated_at).cast("timestamp")
    written: list[str] = []

    def write(name: str, lists: Mapping[str, DataFrame | None], **more: Column) -> None:
        settled = {n: settle(df) if df is not None else None for n, df in lists.items()}
        main = next(iter(settled.values()))
        header = sole_chain(main).select(
            F.lit(SCHEMA_VERSION).alias("schema_version"), iso_utc(stamp).alias("generated_at"),
            *[c.alias(n) for n, c in more.items()], "chain_id",
        )
        empty = main.where(F.lit(False))
        write_document(f"{folder.rstrip('/')}/{name}", header, {n: df or empty for n, df in settled.items()}, joined)
        written.append(name)

    def wanted(name: str, *views: str) -> bool:
        return set(views) <= have and (only is None or name in only)

    if wanted("market_health.json", "v_market_health", "v_market_apy"):
        write("market_health.json", {"markets": market_health_elements(tables, stamp)})
    if wanted("util_spells.json", "v_util_spells"):
        write("util_spells.json", {"spells": spell_elements(open_util_spells(tables), "peak_u")})
    if wanted("market_flows.json", "v_market_flows"):
        through = newest(newest_source(tables, "market_flows"))
        lists = {
            "markets": market_flow_elements(tables),
            "whale_flows": whale_elements(tables) if "v_whale_flows" in have else None,
            "liquidations": liquidation_elements(tables) if "v_liquidations" in have else None,
        }
        synced = F.coalesce(through >= ago(stamp, hours=SYNCED_HOURS), F.lit(False))
        write("market_flows.json", lists, data_through=iso_utc(through), synced=synced)
    if wanted("depeg_spells.json", "v_depeg_spells"):
        elements = spell_elements(open_depeg_spells(tables), "peak_abs_deviation", "peak_deviation")
        write("depeg_spells.json", {"spells": elements})
    return written
