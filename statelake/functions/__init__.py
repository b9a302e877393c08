"""Column expressions. No Python UDF anywhere: everything stays inside codegen."""

from .amounts import double, human, share_pct, text_price, wad
from .clock import floor_to, instant, iso_utc, micros, whole_minutes
from .rates import apy_at_target, borrow_rate, compound_three_terms

__all__ = [
    "apy_at_target", "borrow_rate", "compound_three_terms", "double", "floor_to", "human",
    "instant", "iso_utc", "micros", "share_pct", "text_price", "wad", "whole_minutes",
]
