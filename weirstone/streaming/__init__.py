"""The polling jobs as Structured Streaming queries.

Checkpoints and outputs belong in storage that all executors share. Batch outputs are written
per batch id with overwrite, so a replayed batch after a failure replaces its own files.
"""
