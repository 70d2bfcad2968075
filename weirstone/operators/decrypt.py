"""Decrypt event messages and lift the fields that the warehouse joins on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.dates import epoch_seconds, instant
from weirstone.functions.jsonpath import can_json_parse, once
from weirstone.operators.dedup import dedup_latest
from weirstone.operators.filters import unprocessed
from weirstone.operators.upsert import mark_processed, upsert, without_matches
from weirstone.sources.tables import staged

Decryptor = Callable[[Column], Column]

# Fields lifted out of the payload.
LIFTED = "user_id string,user_uuid string,occurred_at string"
EPOCH = "decimal(20,6)"  # seconds with all microseconds
OK, FAILED = "ok", "failed"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_key", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_uuid", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("dw_created_at", T.TimestampType()),
    ]
)


class Decrypted(NamedTuple):
    ok: DataFrame
    failed: DataFrame


def aes_gcm(key: Column) -> Decryptor:
    """Decryptor for base64 text of AES-GCM content; a bad message gives NULL."""

    def decrypt(message: Column) -> Column:
        content = F.try_to_binary(message, F.lit("base64"))
        return F.try_aes_decrypt(content, key, F.lit("GCM")).cast("string")

    return decrypt


def decryption(df: DataFrame, decryptor: Decryptor, as_of: dt.datetime) -> DataFrame:
    """Every row once, with the columns of ``EVENT_SCHEMA``, a ``status`` and the given row as ``given``.

    ``status`` is ok, or failed for a row that could not be decrypted or is no JSON; its fields
    are NULL. Fields come from the first entry of ``events`` whatever its key, else from the
    document. Decryption and parsing happen once per row, in one projection without a batch size.
    ``decryptor`` maps the message column to text: ``aes_gcm`` in the JVM, or a caller's function.
    """
    plain = once(df.select("event_key", F.struct(*df.columns).alias("given")), __text=decryptor(F.col("given.message")))
    good = F.coalesce(can_json_parse(F.col("__text")), F.lit(False))
    lifted = F.from_json(F.when(good, F.col("__text")), f"{LIFTED},events map<string,struct<{LIFTED}>>")
    payload = F.coalesce(F.get(F.map_values("__doc.events"), F.lit(0)), F.struct("__doc.user_id", "__doc.user_uuid", "__doc.occurred_at"))
    parsed = once(plain, __good=good, __doc=lifted).withColumn("__payload", payload)
    return parsed.select(
        "event_key",
        F.when(F.col("__good"), F.col("__text")).alias("message"),
        F.col("__payload.user_id").try_cast("bigint").alias("user_id"),
        F.col("__payload.user_uuid").alias("user_uuid"),
        epoch_seconds(F.col("__payload.occurred_at").try_cast(EPOCH)).alias("event_timestamp"),
        F.when(F.col("__good"), instant(as_of)).alias("dw_created_at"),
        F.when(F.col("__good"), OK).otherwise(FAILED).alias("status"),
        "given",
    )


def decrypt_events(df: DataFrame, decryptor: Decryptor, as_of: dt.datetime, staging: str | None = None) -> Decrypted:
    """(decrypted events, rows as they were given that could not be decrypted).

    Failures are data, they are neither retried in a loop nor lost. With ``staging`` the pass is
    written there and both parts read it; without, each part is a pass of its own.
    """
    rows = staged(decryption(df, decryptor, as_of), staging)
    ok = rows.filter(F.col("status") == OK).select(*EVENT_SCHEMA.names)
    return Decrypted(ok, rows.filter(F.col("status") == FAILED).select("given.*"))


class Processed(NamedTuple):
    """New state of both tables after one pass, and the rows that stay unprocessed."""

    events: DataFrame
    encrypted: DataFrame
    failed: DataFrame


def process_encrypted(
    encrypted: DataFrame,
    events: DataFrame,
    decryptor: Decryptor,
    as_of: dt.datetime,
    staging: str,
    keys: Sequence[str] = ("event_key", "partition_dt"),
) -> Processed:
    """Decrypt what is unprocessed, add it to ``events`` and mark it in ``encrypted``.

    One pass, written to ``staging`` (a new folder in shared storage), gives the events, the marks
    and the failures. The events are upserted by key, so a pass that is repeated adds nothing
    twice; a key that occurs on several days keeps one event, the one with the greatest message.
    ``keys`` identify a row of ``encrypted``: marks go to the rows that were decrypted and to no
    other day of their key, and a mark that is there is never changed.
    """
    rows = staged(decryption(unprocessed(encrypted), decryptor, as_of), staging)
    good = rows.filter(F.col("status") == OK)
    loaded = dedup_latest(good.select(*EVENT_SCHEMA.names), ["event_key"], [F.col("message").desc()])
    failed = rows.filter(F.col("status") == FAILED).select("given.*")
    done = without_matches(good.select(*[F.col("given")[k].alias(k) for k in keys]).distinct(), failed, keys)
    marked = mark_processed(encrypted, done, keys, instant(as_of))
    return Processed(upsert(events, loaded, ["event_key"], good), marked, failed)


def mark_days(encrypted: DataFrame, processed: Processed, day: str = "partition_dt") -> DataFrame:
    """The marked rows of the days of one pass alone, to replace those days with."""
    days = [r[0] for r in unprocessed(encrypted).select(day).distinct().collect()]  # one value per day
    return processed.encrypted.filter(F.col(day).isin(days))


def register_decryptor(spark: SparkSession, key: str, name: str = "decrypt_message") -> None:
    """SQL function ``name(encrypted) -> text`` for AES-GCM in base64, NULL for a bad message.

    ``key`` is an SQL expression of type binary. The function runs in the JVM and is inlined.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(encrypted STRING) RETURNS STRING "
        f"RETURN CAST(try_aes_decrypt(try_to_binary(encrypted, 'base64'), {key}, 'GCM') AS STRING)"
    )


def register_series_decryptor(spark: SparkSession, function: Callable[[pd.Series, pd.Series], pd.Series], name: str = "decrypt_udf") -> None:
    """Make a caller's ``(encrypted, id) -> text`` over whole series callable from SQL."""

    @F.pandas_udf("string")
    def decrypt(encrypted: pd.Series, ids: pd.Series) -> pd.Series:
        return function(encrypted, ids)

    spark.udf.register(name, decrypt)
