"""Operators bound to the sample tables. Importing this package fills ``QUERIES``."""

from weirstone.bindings import (  # noqa: F401 - modules register their queries on import
    access_queries,
    aggregate_queries,
    load_queries,
    quality_queries,
    report_queries,
    scalar_queries,
    source_queries,
    stream_queries,
)
from weirstone.bindings.registry import QUERIES

__all__ = ["QUERIES"]
