"""Structured Streaming forms of deduplication and time matching."""

from counterfoil.streaming.dedup import Upserted, stream_dedup, stream_records, upsert_records
from counterfoil.streaming.journey import (
    best_candidates,
    frontier,
    journey_between,
    land,
    landed_span,
    late_rows,
    match_landed,
    stream_journey,
    untimed_journey,
)
from counterfoil.streaming.run import drain

__all__ = [
    "Upserted",
    "best_candidates",
    "drain",
    "frontier",
    "journey_between",
    "land",
    "landed_span",
    "late_rows",
    "match_landed",
    "stream_dedup",
    "stream_journey",
    "stream_records",
    "untimed_journey",
    "upsert_records",
]
