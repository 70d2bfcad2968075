"""Typed columns out of JSON log messages."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions.jsonpath import field, with_document


class JsonColumn(NamedTuple):
    """Target column, dotted path in the message, Spark type."""

    column: str
    path: str
    type: str = "string"


def json_columns(lines: str) -> list[JsonColumn]:
    """One ``path type`` per line; the column is named after the last part of the path."""
    pairs = (line.split() for line in lines.strip().splitlines())
    return [JsonColumn(path.rsplit(".", 1)[-1], path, type_name) for path, type_name in pairs]


# The columns of the two log tables, in table order.
EVENT_COLUMNS = json_columns("""
    id string
    name string
    time timestamp
    visitor_id string
    visit_id string
    log_filename string
    properties.new_event boolean
    properties.path string
    properties.user_id string
    properties.locale string
    properties.user_ip string
    properties.hostname string
    properties.pid int
    properties.service_provider string
    properties.trace_id string
    properties.git_sha string
    properties.git_branch string
    properties.user_agent string
    properties.browser_name string
    properties.browser_version string
    properties.browser_platform_name string
    properties.browser_platform_version string
    properties.browser_device_name string
    properties.browser_mobile boolean
    properties.browser_bot boolean
    properties.event_properties.success boolean
""")

REQUEST_COLUMNS = json_columns("""
    uuid string
    method string
    path string
    format string
    controller string
    action string
    status int
    git_sha string
    git_branch string
    timestamp timestamp
    pid int
    user_agent string
    ip string
    host string
    trace_id string
    duration decimal(15,4)
""")

# Log table name -> (columns, key column).
LOG_TABLES = {
    "events": (EVENT_COLUMNS, "id"),
    "production": (REQUEST_COLUMNS, "uuid"),
}


def extract_columns(
    df: DataFrame,
    spec: Sequence[JsonColumn],
    message: str = "message",
    keep: Sequence[str] = ("message", "cloudwatch_timestamp"),
) -> DataFrame:
    """``keep`` first, then one typed column per entry; the message is parsed once per row."""
    document = with_document(df, F.col(message), [c.path for c in spec])
    return document.select(*keep, *[field(c.path, c.type).alias(c.column) for c in spec])
