"""Reusable DataFrame operators behind the views."""

from .asof import asof_join
from .dedupe import keep_one
from .dwell import latch, none_within, seen_within, throughout, trailing_hours
from .islands import threshold_runs
from .latest import at_newest, instants, latest_per_group, latest_rows, latest_value
from .returns import log_return, rolling_volatility
from .selection import (
    above_floor, heal_candidates, not_covered, tracked_set, tracked_tokens, with_fallback,
)
from .shares import share_within, top_k_sum, with_previous
from .tiers import tier, with_leader_spread
from .trailing import ago, avg_where, count_where, indicator, newest, since, sum_where

__all__ = [
    "above_floor", "ago", "asof_join", "at_newest", "avg_where", "count_where",
    "heal_candidates", "indicator", "instants", "keep_one", "latch", "latest_per_group", "latest_rows",
    "latest_value", "log_return", "newest", "none_within", "not_covered", "rolling_volatility", "share_within",
    "seen_within", "since", "sum_where", "threshold_runs", "throughout", "tier", "top_k_sum",
    "tracked_set", "tracked_tokens", "trailing_hours", "with_fallback", "with_leader_spread", "with_previous",
]
