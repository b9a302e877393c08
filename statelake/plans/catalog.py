"""The view catalogue: which views exist, what they need, and their registration."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import book_views, flow_views, market_views, price_views, spell_views, vault_views


@dataclass(frozen=True)
class View:
    build: Callable[..., DataFrame]
    needs: frozenset[str]

    @property
    def name(self) -> str:
        return self.build.__name__


def _view(build: Callable[..., DataFrame], *needs: str) -> View:
    return View(build, frozenset(needs))


_STATE, _PRICED = ("market_state", "markets"), ("market_state", "markets", "prices")

# View names and the stored tables each one needs.
VIEWS: list[View] = [
    _view(market_views.v_market_state, *_STATE),
    _view(vault_views.v_vault_allocations, "vault_allocations", "markets"),
    _view(vault_views.v_vault_snapshot, "vault_allocations", "markets"),
    _view(market_views.v_liquidity_risk, *_STATE),
    _view(price_views.v_prices, "prices", "markets"),
    _view(vault_views.v_vault_drift, "vault_allocations", "markets"),
    _view(market_views.v_market_snapshot, *_STATE),
    _view(book_views.v_position_risk, "positions", "markets"),
    _view(market_views.v_utilization_regime, *_STATE),
    _view(price_views.v_price_returns, "prices", "markets"),
    _view(market_views.v_market_apy, "market_state"),
    _view(market_views.v_market_health, *_PRICED),
    _view(market_views.v_apy_spread, *_PRICED),
    _view(spell_views.v_util_spells, "market_state"),
    _view(market_views.v_benchmark, *_PRICED, "bot_scores"),
    _view(flow_views.v_market_flows, "market_flows", "markets"),
    _view(flow_views.v_market_netflow, "market_flows", "markets"),
    _view(flow_views.v_liquidations, "market_flows", "markets", "prices"),
    _view(flow_views.v_whale_flows, "market_flows", "markets", "market_state"),
    _view(book_views.v_supplier_concentration, "supplier_positions", "markets"),
    _view(market_views.v_oracle_price_check, *_PRICED),
    _view(spell_views.v_depeg_spells, *_PRICED),
]


def buildable(available: Iterable[str]) -> list[View]:
    """Views whose tables are all present, in declared order."""
    have = set(available)
    return [v for v in VIEWS if v.needs <= have]


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """Temp views for the present tables and every view they allow."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    names = list(tables)
    for view in buildable(tables):
        view.build(tables).createOrReplaceTempView(view.name)
        names.append(view.name)
    return sorted(names)
