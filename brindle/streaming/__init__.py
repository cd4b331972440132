"""Structured Streaming: event-time operators with bounded state."""

from brindle.streaming.events import deduplicated, event_time, running_totals, session_counts, stream_join, tumbling
from brindle.streaming.ledger import day_totals, drained, first_seen, late_day_totals, with_rocks
from brindle.streaming.upsert import Upserts, upserted

__all__ = [
    "Upserts", "day_totals", "deduplicated", "drained", "event_time", "first_seen", "late_day_totals", "running_totals", "session_counts", "stream_join", "tumbling", "upserted", "with_rocks",
]
