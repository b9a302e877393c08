"""File readers, the log stream, the pool reader and the default spells."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statelake.plans import market_views, spell_views
from statelake.plans.reader import Reader
from statelake.session import shared_dir
from statelake.sources import Lake, payloads, snapshots
from statelake.sources.event_log import event_rows, read_log, score_rows, split_lines
from statelake.streaming.ingest import ingest_growing_logs, ingest_logs
from statelake.tables import BOT_EVENTS, BOT_SCORES

from .adapters import Given
from .payload_queries import js, legacy_entry, log_lines, pool_documents
from .prelude import CTES, with_tables
from .spec import Query
from .view_queries import ORACLE, SD, SIX, SMP, spells_sql


def named_files(g: Given, rows: DataFrame, order: str) -> str:
    """One text file for each ``file`` of ``rows`` (file, line), named like it; returns the folder."""
    base = f"{shared_dir(g.spark)}/files-{uuid.uuid4().hex}"
    dealt = rows.repartition("file").sortWithinPartitions("file", order)
    dealt.select("file", "line").write.partitionBy("file").text(f"{base}/parts")
    jvm = g.spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(base).getFileSystem(g.spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{base}/out"))
    # A file is one day's: the loop is as long as the days.
    for folder in fs.listStatus(path(f"{base}/parts")):
        name = folder.getPath().getName()
        if name.startswith("file="):
            for part in fs.listStatus(folder.getPath()):
                if part.getPath().getName().startswith("part-"):
                    fs.rename(part.getPath(), path(f"{base}/out/{name.removeprefix('file=')}"))
    return f"{base}/out"


def log_folder(g: Given) -> str:
    return named_files(g, log_lines(g).select(F.col("source_file").alias("file"), "line", "seq"), "seq")


def file_events(g: Given) -> DataFrame:
    return event_rows(split_lines(read_log(g.spark, log_folder(g))))


def file_scores(g: Given) -> DataFrame:
    return score_rows(split_lines(read_log(g.spark, log_folder(g)))).select("tick_id", "market_id", "u", "source_file", "seq")


def file_rejects(g: Given) -> DataFrame:
    return split_lines(read_log(g.spark, log_folder(g))).where(~F.col("ok")).select("source_file", "seq", "line")


def streamed_logs(g: Given) -> DataFrame:
    """Events, scores and rejects as the stream has stored them."""
    base = f"{shared_dir(g.spark)}/ingest-{uuid.uuid4().hex}"
    lake = Lake(g.spark, f"{base}/lake")
    ingest_logs(g.spark, log_folder(g), lake, f"{base}/rejected", f"{base}/checkpoint").awaitTermination()
    events = lake.scan(BOT_EVENTS).select("tick_id", F.col("type").alias("kind"), "source_file")
    scores = lake.scan(BOT_SCORES).select("tick_id", F.concat(F.lit("score "), "market_id").alias("kind"), "source_file")
    bad = g.spark.read.schema("source_file string, seq int, line string").json(f"{base}/rejected").select(
        F.regexp_extract("line", '"tickId":"(t[0-9]+)"', 1).alias("tick_id"), F.lit("rejected").alias("kind"), "source_file")
    return events.union(scores).union(bad)


def grown_logs(g: Given) -> DataFrame:
    """Files read when they held the first half of their lines, and again when they had grown, with line numbers going on."""
    base = f"{shared_dir(g.spark)}/grown-{uuid.uuid4().hex}"
    lake = Lake(g.spark, f"{base}/lake")
    lines = log_lines(g).select(F.col("source_file").alias("file"), "line", "seq")
    sizes = lines.groupBy("file").agg((F.count(F.lit(1)) / 2).alias("half"))
    numbered = lines.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("seq")))
    folder = named_files(g, numbered.join(sizes, "file").where("place <= half"), "seq")

    def run() -> None:
        ingest_growing_logs(g.spark, folder, lake, f"{base}/rejected", f"{base}/checkpoint", chunk_bytes=1 << 16).awaitTermination()

    run()
    moved(g, named_files(g, lines, "seq"), folder)
    run()
    events = lake.scan(BOT_EVENTS).select("tick_id", F.col("type").alias("kind"), "source_file", "seq")
    scores = lake.scan(BOT_SCORES).select("tick_id", F.concat(F.lit("score "), "market_id").alias("kind"), "source_file", F.lit(-1).alias("seq"))
    bad = g.spark.read.schema("source_file string, seq int, line string").json(f"{base}/rejected").select(
        F.regexp_extract("line", '"tickId":"(t[0-9]+)"', 1).alias("tick_id"), F.lit("rejected").alias("kind"), "source_file", "seq")
    return events.union(scores).union(bad)


def moved(g: Given, folder: str, target: str) -> None:
    """A folder's files, one a day, in the place of those of their names."""
    path = g.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(g.spark.sparkContext._jsc.hadoopConfiguration())
    for file in fs.listStatus(path(folder)):
        final = path(f"{target}/{file.getPath().getName()}")
        fs.delete(final, False)
        fs.rename(file.getPath(), final)


def snapshot_files(g: Given) -> DataFrame:
    """One document per day, written to a file of its own and read back."""
    days = g.events().groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.concat_ws(",", F.collect_list(legacy_entry())).alias("body"))
    docs = days.select(
        F.concat(F.lit("snapshot-"), F.date_format("day", "yyyy-MM-dd"), F.lit(".json")).alias("file"),
        js('{"timestamp":"<t>","chainId":999,"markets":[<b>]}', t=F.date_format("day", "yyyy-MM-dd'T'HH:mm:ss'Z'"), b="body").alias("line"))
    return snapshots.legacy_rows(snapshots.read_snapshots(g.spark, named_files(g, docs, "line")))


def pools(g: Given) -> DataFrame:
    return Reader(g.spark, {"yield_pools": payloads.yield_pools(pool_documents(g), [f"NATION_{n}" for n in range(25)])}).yield_pools(since="2024-01-01 00:00:00")


class Dense(Given):
    """All events on five markets: a sample every twenty minutes or so."""

    def events(self) -> DataFrame:
        return super().events().withColumn("user_id", F.col("user_id") % 5 + 4)


def dense(g: Given) -> dict[str, DataFrame]:
    return {**g.tables("markets", "prices"), "market_state": Dense(g.spark, g.dir).table("market_state")}


DENSE = CTES["market_state"].replace("FROM events", "FROM (SELECT * REPLACE (user_id % 5 + 4 AS user_id) FROM events)")
DAY_FILE = "'events-' || strftime(ts, '%Y-%m-%d') || '.jsonl'"
NUMBERED = f"(SELECT *, {DAY_FILE} AS source_file, CAST(row_number() OVER (PARTITION BY {DAY_FILE} ORDER BY event_id) - 1 AS INTEGER) AS seq FROM events)"
BAD_LINE = f"""'{{"ts":"' || strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%gZ') || '","bot":"b","chainId":999,"tickId":"t' || event_id || '"'
    || if(event_id % 2 = 0, ',"type":"mystery"}}', ',"type":"tick_end"')"""


def dense_tables(body: str, **extra: str) -> str:
    first, rest = f"WITH market_state AS ({DENSE})", with_tables(body, "markets", "prices", **SD, **extra)
    return f"{first}, {rest.removeprefix('WITH ')}"


SOURCE_QUERIES = [
    Query(
        "log_file_events", file_events,
        f"""SELECT date_trunc('milliseconds', ts) AS ts, 999 AS chain_id, 't' || event_id AS tick_id, seq,
                  CASE event_type WHEN 'click' THEN 'tx_confirmed' WHEN 'signup' THEN 'tick_start' ELSE 'error' END AS type,
                  CASE WHEN event_type = 'click' THEN '0x' || event_id END AS tx_hash, CASE WHEN event_type = 'click' THEN event_id END AS block_number,
                  CASE event_type
                    WHEN 'click' THEN '{{"alpha":{{"a":"x y","b":[1,2]}},"tx":{{"blockNumber":' || event_id || ',"gas":"9"}},"zeta":' || user_id || '}}'
                    WHEN 'purchase' THEN '{{"reason":"r' || user_id || '","tx":"none"}}' END AS payload, source_file
           FROM {NUMBERED} WHERE event_type IN ('click', 'signup', 'purchase')""", exact=("block_number",),
    ),
    Query(
        "log_file_scores", file_scores,
        f"""SELECT 't' || event_id AS tick_id, 'm' || user_id || '_' || n AS market_id, value / 500.0 AS u, source_file, seq
            FROM {NUMBERED}, (VALUES (1), (2)) AS k(n) WHERE event_type = 'view'""", {"u": 6},
    ),
    Query(
        "log_file_rejects", file_rejects,
        f"SELECT source_file, seq, {BAD_LINE} AS line FROM {NUMBERED} WHERE event_type = 'error'",
    ),
    Query(
        "stream_log_files", streamed_logs,
        f"""SELECT 't' || event_id AS tick_id, {DAY_FILE} AS source_file,
                   CASE event_type WHEN 'click' THEN 'tx_confirmed' WHEN 'signup' THEN 'tick_start' WHEN 'purchase' THEN 'error' ELSE 'rejected' END AS kind
            FROM events WHERE event_type <> 'view'
            UNION ALL SELECT 't' || event_id, {DAY_FILE}, 'score m' || user_id || '_' || n FROM events, (VALUES (1), (2)) AS k(n) WHERE event_type = 'view'""",
    ),
    Query(
        "stream_growing_logs", grown_logs,
        f"""SELECT 't' || event_id AS tick_id, source_file, seq,
                   CASE event_type WHEN 'click' THEN 'tx_confirmed' WHEN 'signup' THEN 'tick_start' WHEN 'purchase' THEN 'error' ELSE 'rejected' END AS kind
            FROM {NUMBERED} WHERE event_type <> 'view'
            UNION ALL SELECT 't' || event_id, source_file, -1, 'score m' || user_id || '_' || n FROM {NUMBERED}, (VALUES (1), (2)) AS k(n) WHERE event_type = 'view'""",
    ),
    Query(
        "snapshot_files", snapshot_files,
        """SELECT date_trunc('day', ts) AS ts, 999 AS chain_id, 'm' || user_id AS market_id, 'S' || user_id AS symbol, '0xl' || user_id AS loan_token,
                  CASE WHEN event_id % 4 <> 0 THEN '0xc' || user_id END AS collateral_token, value AS utilization, value AS borrow_apy,
                  0.5 AS supply_apy, value AS available_liquidity, CAST(NULL AS DOUBLE) AS vault_allocation,
                  'snapshot-' || strftime(ts, '%Y-%m-%d') || '.json' AS source_file
           FROM events""",
        {"utilization": 6, "borrow_apy": 6, "supply_apy": 6, "available_liquidity": 6, "vault_allocation": 6},
    ),
    Query(
        "read_yield_pools", pools,
        """SELECT TIMESTAMP '2024-01-31 00:00:00' AS ts, 'p' || s_suppkey AS pool_id, 'NATION_' || s_nationkey AS chain, 'x' AS project,
                  'S' || s_suppkey AS symbol, s_acctbal AS tvl_usd, s_suppkey % 40 / 4.0 AS apy, s_suppkey % 40 / 4.0 AS apy_base,
                  CASE WHEN s_suppkey % 2 = 0 THEN 1.5 END AS apy_reward
           FROM supplier""", {"tvl_usd": 6, "apy": 6, "apy_base": 6, "apy_reward": 6},
    ),
    Query(
        "v_util_spells_default", lambda g: spell_views.v_util_spells(dense(g)),
        dense_tables(spells_sql("market_state", "utilization", (0.92, 0.95), 2,
                                "max(utilization) AS peak_u, min(CAST(total_supply_assets - total_borrow_assets AS DOUBLE)) AS min_available_liquidity")),
        SIX("threshold", "peak_u", "min_available_liquidity"),
    ),
    Query(
        "v_depeg_spells_default", lambda g: spell_views.v_depeg_spells(dense(g)),
        dense_tables(spells_sql("(FROM checks WHERE deviation IS NOT NULL)", "abs(deviation)", (0.02, 0.05), 2,
                                "max(abs(deviation)) AS peak_abs_deviation, first(deviation ORDER BY abs(deviation) DESC, ts) AS peak_deviation"), checks=ORACLE),
        SIX("threshold", "peak_abs_deviation", "peak_deviation"),
    ),
]
