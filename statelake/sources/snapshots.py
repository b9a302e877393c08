"""Folders of one-document JSON snapshots (an older format)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.functions.clock import instant

FILE_PATTERN = "snapshot-*.json"
_DOCUMENT = (
    "timestamp string, chainId int, markets array<struct<symbol:string,marketId:string,loan:string,"
    "collateral:string,utilisation:double,utilization:double,borrowAPY:double,supplyAPY:double,"
    "availableLiquidity:double,vaultAllocation:double>>, _bad string"
)


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One row per readable document; unreadable files are skipped."""
    docs = (
        spark.read.schema(_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("pathGlobFilter", FILE_PATTERN)
        .json(folder)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    whole = ~F.coalesce(F.exists("markets", lambda m: m["marketId"].isNull()), F.lit(False))
    return docs.where(F.col("_bad").isNull() & instant("timestamp").isNotNull() & whole)


def legacy_rows(docs: DataFrame) -> DataFrame:
    m = F.col("m")
    address = lambda c: F.nullif(F.lower(c), F.lit(""))
    return docs.select(
        instant("timestamp").alias("ts"),
        F.coalesce("chainId", F.lit(0)).alias("chain_id"),
        "source_file",
        F.explode("markets").alias("m"),
    ).select(
        "ts",
        "chain_id",
        m["marketId"].alias("market_id"),
        m["symbol"].alias("symbol"),
        address(m["loan"]).alias("loan_token"),
        address(m["collateral"]).alias("collateral_token"),
        F.coalesce(m["utilisation"], m["utilization"]).alias("utilization"),
        m["borrowAPY"].alias("borrow_apy"),
        m["supplyAPY"].alias("supply_apy"),
        m["availableLiquidity"].alias("available_liquidity"),
        m["vaultAllocation"].alias("vault_allocation"),
        "source_file",
    )
