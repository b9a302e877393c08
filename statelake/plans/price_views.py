"""Views over token prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statelake.operators import log_return, rolling_volatility

from .market_views import Tables

TOKEN = ["chain_id", "token_address"]


def named(df: DataFrame, t: Tables) -> DataFrame:
    """``df`` with the token's symbol, looked up among loan tokens first, then collateral."""

    def role(kind: str):
        return t["markets"].select(
            "chain_id", F.col(f"{kind}_token").alias("token_address"), F.col(f"{kind}_symbol").alias(f"_{kind}")
        ).distinct()

    df = df.join(role("loan"), TOKEN, "left").join(role("collateral"), TOKEN, "left")
    return df.withColumn("symbol", F.coalesce("_loan", "_collateral")).drop("_loan", "_collateral")


def v_prices(t: Tables) -> DataFrame:
    """Prices with a symbol. A token listed under several symbols repeats its price rows."""
    return named(t["prices"], t).select("ts", *TOKEN, "symbol", "price_usd", "source", "confidence")


def token_returns(t: Tables) -> DataFrame:
    """Hourly log returns and trailing annualised volatility, one row per token and hour.

    Symbols play no part: prices are unique per token and instant, so every return
    has one predecessor.
    """
    hourly = t["prices"].where((F.minute("ts") == 0) & (F.col("price_usd") > 0)).select("ts", *TOKEN, "price_usd")
    df = hourly.withColumn("log_return_1h", log_return("price_usd", TOKEN))
    return rolling_volatility(df, "log_return_1h", TOKEN, {"vol_7d_ann": 7, "vol_30d_ann": 30})


def v_price_returns(t: Tables) -> DataFrame:
    """Returns with a symbol; every symbol of a token repeats the same return."""
    return named(token_returns(t), t).select(
        "ts", *TOKEN, "symbol", "price_usd", "log_return_1h", "vol_7d_ann", "vol_30d_ann")
