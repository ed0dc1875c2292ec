"""Structured Streaming: inbox ingestion, event analytics."""

from .phases import intervals, samples_within, summed
from .jobs import job_changes, job_table, keep_jobs, latest_jobs
from .ingest import event_stream, events_by_window, inbox, run_always, run_once

__all__ = ["intervals", "samples_within", "summed", "job_changes", "job_table", "keep_jobs", "latest_jobs", "event_stream", "events_by_window", "inbox", "run_always", "run_once"]
