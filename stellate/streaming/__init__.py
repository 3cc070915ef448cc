"""Incremental loading of landed files with Structured Streaming.

The reference has no stream: its jobs run as batches.  This package only
schedules the same batch operators on files as they land (``foreachBatch``),
so a dimension is merged and republished once per micro-batch.
"""

from stellate.streaming.incremental import dedupe_latest, merge_loader, run_incremental  # noqa: F401
