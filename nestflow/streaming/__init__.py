"""Incremental execution of the batch pipelines with Structured Streaming."""

from nestflow.streaming.incremental import run_incremental

__all__ = ["run_incremental"]
