"""Alert on large exports as they are logged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.operators.quality import EXPORT_LINES, export_findings


def large_export_stream(stream: DataFrame, lines: int = EXPORT_LINES) -> DataFrame:
    """Each export over the threshold once; a stateless filter needs no look-back window."""
    return export_findings(stream.filter(F.col("line_count") > lines))
