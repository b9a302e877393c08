"""Append-only JSON-lines logs: new complete lines in, typed rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statelake.functions.clock import floor_to, instant

# Accepted event types and the envelope fields that get columns.
KNOWN_TYPES = [
    "tick_start", "tick_end", "tick_skip", "scores", "plan_built", "plan_simulated",
    "tx_sent", "tx_confirmed", "tx_reverted", "error",
]
ENVELOPE = ["ts", "bot", "chainId", "type", "tickId", "txHash"]
FILE_PATTERN = "events-*.jsonl"

_EVENT = (
    "ts string, chainId string, type string, tickId string, txHash string, vault string, "
    "totalAssets string, idleAssets string, scores array<struct<marketId:string,collateralSymbol:string,"
    "loanSymbol:string,u:double,apy:double,exitRatio:double,score:double,gate:string,vaultAssets:string>>"
)


def log_source(reader, folder: str) -> DataFrame:
    """Raw lines with where they came from; ``reader`` is a batch or stream reader."""
    return (
        reader.option("lineSep", "\n")
        .option("pathGlobFilter", FILE_PATTERN)
        .format("text")
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_size").alias("_size"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("value").alias("line"),
        )
    )


def number_lines(source: DataFrame) -> DataFrame:
    """(source_file, seq, line) for every complete line.

    ``seq`` is the line index inside its file. Large files are read in parallel
    blocks: the index is the block's first line number plus the line's place in
    its block. A last line without a newline is still being written and is left
    for the next read; it shows as one byte more than the file holds.
    """
    raw = source.withColumn("_pos", F.monotonically_increasing_id())
    blocks = raw.groupBy("_path", "_block").agg(
        F.min("_pos").alias("_first"),
        F.count(F.lit(1)).alias("_lines"),
        F.sum(F.octet_length("line") + 1).alias("_bytes"),
        F.max("_size").alias("_size"),
    )
    # One row per block of a file: short windows, small join side.
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_path")
    unfinished = F.when(F.sum("_bytes").over(whole) > F.col("_size"), 1).otherwise(0)
    placed = blocks.select(
        "_path", "_block", "_first",
        F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_offset"),
        (F.sum("_lines").over(whole) - unfinished).alias("_complete"),
    )
    seq = F.col("_offset") + F.col("_pos") - F.col("_first")
    return (
        raw.join(placed, ["_path", "_block"])
        .withColumn("seq", seq.cast("int"))
        .where(F.col("seq") < F.col("_complete"))
        .select("source_file", "seq", "line")
    )


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every complete line of every log file in the folder."""
    return number_lines(log_source(spark.read, folder))


def split_lines(lines: DataFrame) -> DataFrame:
    """Adds ``event`` (typed envelope), ``fields`` (all of the line's fields) and
    ``ok``; unreadable lines and unknown types have ok = false."""
    both = F.struct(
        F.from_json("line", _EVENT, {"mode": "PERMISSIVE"}).alias("event"), F.try_parse_json("line").alias("fields")
    )
    # Generated, so that a filter on the result does not parse the line again.
    parsed = lines.select("*", F.inline(F.array(both)))
    ok = (
        F.col("fields").isNotNull()
        & F.coalesce(F.col("event.type").isin(KNOWN_TYPES), F.lit(False))
        & instant("event.ts").isNotNull()
    )
    return parsed.withColumn("ok", ok)


def score_rows(split: DataFrame) -> DataFrame:
    """One row per scored market; the tick's instant is floored to the minute."""
    e = F.col("event")
    events = split.where(F.col("ok") & (e["type"] == "scores"))
    return events.select("source_file", "seq", e.alias("event"), F.explode("event.scores").alias("s")).select(
        floor_to(instant("event.ts"), 60).alias("ts"),
        e["chainId"].cast("int").alias("chain_id"),
        e["vault"].alias("vault"),
        e["tickId"].alias("tick_id"),
        F.col("s.marketId").alias("market_id"),
        F.col("s.collateralSymbol").alias("collateral_symbol"),
        F.col("s.loanSymbol").alias("loan_symbol"),
        F.col("s.u").alias("u"),
        F.col("s.apy").alias("apy"),
        F.col("s.exitRatio").alias("exit_ratio"),
        F.col("s.score").alias("score"),
        F.col("s.gate").alias("gate"),
        F.col("s.vaultAssets").cast("decimal(38,0)").alias("vault_assets"),
        e["totalAssets"].cast("decimal(38,0)").alias("total_assets"),
        e["idleAssets"].cast("decimal(38,0)").alias("idle_assets"),
        "source_file",
        "seq",
    )


def event_rows(split: DataFrame) -> DataFrame:
    """One row per other event; fields outside the envelope become sorted-key JSON."""
    e = F.col("event")
    events = split.where(F.col("ok") & (e["type"] != "scores"))
    entries = F.map_entries(F.col("fields").cast("map<string,variant>"))
    extra = F.filter(entries, lambda x: ~x["key"].isin(ENVELOPE))
    in_order = F.array_sort(
        extra, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    )
    payload = F.when(F.size(extra) > 0, F.to_json(F.map_from_entries(in_order)))
    return events.select(
        instant("event.ts").alias("ts"),
        e["chainId"].cast("int").alias("chain_id"),
        e["tickId"].alias("tick_id"),
        "seq",
        e["type"].alias("type"),
        e["txHash"].alias("tx_hash"),
        F.try_variant_get("fields", "$.tx.blockNumber", "decimal(38,0)").alias("block_number"),
        payload.alias("payload"),
        "source_file",
    )
