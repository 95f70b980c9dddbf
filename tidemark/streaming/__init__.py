"""Structured Streaming forms of the incremental load and the trailing-window reports."""
