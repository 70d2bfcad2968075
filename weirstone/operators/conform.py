"""Bring a table to a declared list of columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.dates import instant
from weirstone.functions.text import pg_array_to_array

# Load-time columns, default text length, names of declared types.
LOAD_COLUMNS = ("dw_created_at", "dw_updated_at")
DEFAULT_TEXT_LIMIT = 256
TYPE_NAMES = {
    "string": "string",
    "text": "string",
    "json": "string",
    "jsonb": "string",
    "array": "array<string>",
    "integer": "int",
    "bigint": "bigint",
    "float": "double",
    "double": "double",
    "boolean": "boolean",
    "date": "date",
    "datetime": "timestamp",
    "timestamp": "timestamp",
}


class ColumnSpec(NamedTuple):
    name: str
    datatype: str
    not_null: bool = False
    limit: int | None = None

    @property
    def spark_type(self) -> str:
        return TYPE_NAMES.get(self.datatype, self.datatype)

    @property
    def text_limit(self) -> int | None:
        return self.limit or (DEFAULT_TEXT_LIMIT if self.datatype in ("string", "text") else None)


def column_specs(entries: Sequence[dict]) -> list[ColumnSpec]:
    """From configuration entries; other keys than those of ``ColumnSpec`` are ignored."""
    fields = ColumnSpec._fields
    return [ColumnSpec(**{k: v for k, v in entry.items() if k in fields}) for entry in entries]


def _conformed(df: DataFrame, spec: ColumnSpec) -> Column:
    if spec.name not in df.columns:
        return F.lit(None).cast(spec.spark_type)
    if spec.datatype == "array" and isinstance(df.schema[spec.name].dataType, T.StringType):
        return pg_array_to_array(F.col(spec.name))
    return F.col(spec.name).try_cast(spec.spark_type)


def conform(df: DataFrame, specs: Sequence[ColumnSpec], as_of: dt.datetime) -> DataFrame:
    """One projection: add missing columns, change types, drop unlisted columns, add load times.

    A value that does not fit its new type becomes NULL; ``conform_issues`` counts those.
    """
    loads = [
        (F.col(c) if c in df.columns else instant(as_of)).alias(c) for c in LOAD_COLUMNS
    ]
    return df.select(*[_conformed(df, s).alias(s.name) for s in specs], *loads)


def conform_issues(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """One row per declared column: lost casts, NULLs in NOT NULL columns, texts over the limit."""
    checks = []
    for s in specs:
        present = F.col(s.name).isNotNull() if s.name in df.columns else F.lit(False)
        value = _conformed(df, s)
        too_long = F.length(value) > s.text_limit if s.spark_type == "string" and s.text_limit else F.lit(False)
        checks.append(
            F.struct(
                F.lit(s.name).alias("column_name"),
                F.count_if(present & value.isNull()).alias("bad_casts"),
                F.count_if(value.isNull() if s.not_null else F.lit(False)).alias("null_violations"),
                F.count_if(too_long).alias("too_long"),
            )
        )
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def schema_diff(schema: T.StructType, specs: Sequence[ColumnSpec]) -> list[tuple[str, str]]:
    """(column, action) with action add, change or drop."""
    current = {f.name: f.dataType.simpleString() for f in schema}
    actions = []
    for s in specs:
        if s.name not in current:
            actions.append((s.name, "add"))
        elif current[s.name] != s.spark_type:
            actions.append((s.name, "change"))
    actions += [(c, "add") for c in LOAD_COLUMNS if c not in current]
    wanted = {s.name for s in specs} | set(LOAD_COLUMNS)
    return actions + [(c, "drop") for c in current if c not in wanted]


def split_pii(
    df: DataFrame, key: str, specs: Sequence[ColumnSpec], pii_specs: Sequence[ColumnSpec], as_of: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """(table, PII table): two projections that share the key column."""
    names = [s.name for s in pii_specs]
    if key not in names:
        raise ValueError(f"the PII table needs the key column {key}")
    return conform(df, specs, as_of), conform(df, pii_specs, as_of)
