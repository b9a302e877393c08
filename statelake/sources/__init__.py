"""Stored tables, raw payloads, event logs and snapshot folders."""

from .event_log import event_rows, read_log, score_rows, split_lines
from .resume import resume_from
from .snapshots import legacy_rows, read_snapshots
from .store import Lake, coerce

__all__ = [
    "Lake", "coerce", "event_rows", "legacy_rows", "read_log", "read_snapshots", "resume_from",
    "score_rows", "split_lines",
]
