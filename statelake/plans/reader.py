"""The read API. Every method returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Mapping
from copy import copy
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.operators import at_newest, instants, latest_rows
from statelake.sources.store import Lake

from . import catalog
from .catalog import VIEWS

_BUILD = {v.name: v.build for v in VIEWS}


def only(since: str | datetime | None = None, **equal: str | None) -> Column:
    """Conjunction of the given equalities and ``ts >= since``; None means no limit."""
    condition = F.lit(True)
    for column, value in equal.items():
        if value is not None:
            condition = condition & (F.col(column) == F.lit(value))
    if since is not None:
        condition = condition & (F.col("ts") >= F.lit(since).cast("timestamp"))
    return condition


def pruned(df: DataFrame, since: str | datetime | None) -> DataFrame:
    """Skips whole day partitions before ``since`` on a stored table."""
    if since is None or "date" not in df.columns:
        return df
    return df.where(F.col("date") >= F.to_date(F.lit(since).cast("timestamp")))


class Reader:
    """Typed access to a lake's tables and views.

    ``source`` is a lake's folder, or a mapping of table names to DataFrames.
    """

    def __init__(self, spark: SparkSession, source: str | Mapping[str, DataFrame]) -> None:
        self.spark = spark
        self._source = source
        self.refresh()

    def refresh(self) -> None:
        """Look again at what is stored and register the views it allows."""
        if isinstance(self._source, Mapping):
            self._tables = self._source
        else:
            self._tables = Lake(self.spark, self._source).tables()
        self._names = catalog.register(self.spark, self._tables)

    def tables(self) -> list[str]:
        """Stored tables and views that can be queried now."""
        return list(self._names)

    def sql(self, query: str, params: list | None = None) -> DataFrame:
        """Any SQL over tables and views; ``?`` marks take ``params`` in order."""
        return self.spark.sql(query, args=params) if params else self.spark.sql(query)

    def _view(self, name: str, since: str | datetime | None = None, table: str | None = None) -> DataFrame:
        tables = self._tables
        return _BUILD[name](tables if table is None else self._with(table, pruned(tables[table], since)))

    def _with(self, name: str, df: DataFrame) -> Mapping[str, DataFrame]:
        """The tables with another one in a table's place."""
        tables = copy(self._tables)
        tables[name] = df
        return tables

    def market_state(self, loan: str | None = None, collateral: str | None = None, since=None) -> DataFrame:
        df = self._view("v_market_state", since, "market_state")
        return df.where(only(since, loan_symbol=loan, collateral_symbol=collateral)).orderBy("market_id", "ts")

    def market_state_latest(self) -> DataFrame:
        keys, t = ["chain_id", "market_id"], self._tables
        newest = latest_rows(at_newest(t["market_state"], instants(t, "market_state"), keys), keys)
        return _BUILD["v_market_state"](self._with("market_state", newest))

    def liquidity_risk(self) -> DataFrame:
        return self._view("v_liquidity_risk").orderBy(F.col("pct_time_gt99").desc_nulls_last())

    def vault_snapshot(self, vault: str | None = None) -> DataFrame:
        df = self._view("v_vault_snapshot").where(only(vault=vault and vault.lower()))
        return df.orderBy("vault", F.col("weight_pct").desc_nulls_last())

    def vault_allocations(self, vault: str | None = None, since=None) -> DataFrame:
        df = self._view("v_vault_allocations", since, "vault_allocations")
        return df.where(only(since, vault=vault and vault.lower())).orderBy("vault", "market_id", "ts")

    def prices(self, symbol: str | None = None, since=None) -> DataFrame:
        df = self._view("v_prices", since, "prices")
        return df.where(only(since, symbol=symbol)).orderBy("token_address", "ts")

    def positions(self, market_id: str | None = None) -> DataFrame:
        df = self._tables["positions"].where(only(market_id=market_id))
        return df.orderBy("ts", F.col("borrow_shares").desc_nulls_last())

    def yield_pools(self, since=None) -> DataFrame:
        df = pruned(self._tables["yield_pools"], since).where(only(since))
        return df.orderBy("ts", F.col("tvl_usd").desc_nulls_last())
