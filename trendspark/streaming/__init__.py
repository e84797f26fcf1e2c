"""Structured Streaming operators."""

from trendspark.streaming.counters import Counters
from trendspark.streaming.hours import HourLanding, start_hour_landing
from trendspark.streaming.ingest import (KeyedArchive, archive_batch_writer, dedup_within_watermark,
                                         event_time, file_stream, first_per_key,
                                         hourly_counts, new_rows_only, start_ingest, touched_days)
from trendspark.streaming.sessions import run_session, run_sessions

__all__ = ["Counters", "HourLanding", "KeyedArchive", "archive_batch_writer", "dedup_within_watermark", "event_time",
           "file_stream", "first_per_key", "hourly_counts", "new_rows_only", "run_session", "run_sessions",
           "start_hour_landing", "start_ingest", "touched_days"]
