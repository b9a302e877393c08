"""The same behaviours as Structured Streaming jobs."""

from .flows import deduplicated, hourly_net_flow
from .ingest import ingest_growing_logs, ingest_logs, keyed_merge, last_in_bucket, start_merge
from .latches import online_latch

__all__ = ["deduplicated", "hourly_net_flow", "ingest_growing_logs", "ingest_logs", "keyed_merge", "last_in_bucket", "online_latch", "start_merge"]
