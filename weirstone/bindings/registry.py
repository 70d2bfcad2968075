"""Named queries over the sample tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.session import use_utc
from weirstone.sources.tables import read_table


class Tables:
    """Sample tables as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, root: str) -> DataFrame:
        return self.build(Tables(spark, root))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in QUERIES:
            raise ValueError(f"duplicate query {build.__name__}")
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return register


def stamp(column: Column | str) -> Column:
    """Timestamp as text with microseconds, the same in both engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sql_stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def k(props: str = "props") -> Column:
    """The number in an event's properties."""
    return F.get_json_object(props, "$.k").cast("int")


SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
