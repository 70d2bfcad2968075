"""Rows that could not be processed, kept as keyed state and tried again when a timer is due.

A run hands over the rows that failed in it. Each one becomes a state of its own, with a timer for
its next attempt; a timer that is due emits the row, and what the attempt gives comes back as the
input of the next run. So a run reads what has come since and what is due, never what went before.

Time is event time. It moves by one tick per run: the run's time, and at least a second after the
tick before it, so it neither stands still nor goes back. Failed rows and outcomes carry no event time and
cannot be late. The files of outcomes are written per batch with overwrite and are first listed when
a later batch is planned, so a replayed batch replaces what it had written unseen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirstone.streaming.batches import folders, has_batches, remove
from weirstone.streaming.runner import drain_to_batches, write_batch

OK, FAILED, EXPIRED = "ok", "failed", "expired"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TEXT_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


class Retries(NamedTuple):
    """When to try again: after ``delay``, then after ``growth`` times the last wait, ``longest`` at most.

    A delay of zero means the next run. After ``attempts`` failures, the first one included, a row
    expires; without a number it is tried for ever.
    """

    delay: dt.timedelta = dt.timedelta(0)
    growth: float = 2.0
    longest: dt.timedelta = dt.timedelta(days=1)
    attempts: int | None = None

    def wait_ms(self, failures: int) -> int:
        """Milliseconds to wait after so many failures."""
        first, most = (max(1, int(d.total_seconds() * 1000)) for d in (self.delay, self.longest))
        wait = first
        for _ in range(failures - 1):
            if wait >= most:
                break
            wait = max(wait + (self.growth > 1), int(wait * self.growth))
        return min(wait, most) if self.delay else 1


class Pending(StatefulProcessor):
    """One failed row per key: the row, its failures so far, and a timer for the next attempt."""

    def __init__(self, retries: Retries):
        self.retries = retries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "row string, failures int")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        failed, settled = None, False
        for row in rows:
            if row.kind == OK:
                settled = True
            elif failed is None or row.tried_at < failed.tried_at:
                failed = row
        if settled:
            self._forget()
        elif failed is not None and not self.pending.exists():
            if self.retries.attempts == 1:
                yield Row(id=key[0], row=failed.row, last=True)
            else:
                self._keep(failed.row, 1, failed.tried_at)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.pending.get()
        if held is None:
            return
        row, failures = held
        last = self.retries.attempts is not None and failures + 1 >= self.retries.attempts
        if last:
            self._forget()
        else:  # kept until the outcome is known
            self._keep(row, failures + 1, timerValues.getCurrentWatermarkInMs())
        yield Row(id=key[0], row=row, last=last)

    def close(self) -> None:
        pass

    def _keep(self, row: str, failures: int, now: int) -> None:
        self.pending.update((row, failures))
        self.handle.registerTimer(now + self.retries.wait_ms(failures))

    def _forget(self) -> None:
        self.pending.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Keyed state with timers needs this provider; the session's own comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def as_text(row: Column) -> Column:
    """A struct as JSON that ``from_text`` reads back to the microsecond."""
    return F.to_json(row, TEXT_OPTIONS)


def from_text(row: Column, schema: T.StructType) -> Column:
    return F.from_json(row, schema, TEXT_OPTIONS)


def _ticks(path: str) -> str:
    return f"{path}__retry/ticks"


def attempts_path(path: str) -> str:
    """Folder of what came of the attempts, by batch and status."""
    return f"{path}__retry/attempts"


def _state(path: str) -> str:
    return f"{path}__retry/state"


def next_tick(spark: SparkSession, path: str, as_of: dt.datetime) -> int:
    """Milliseconds of this run: ``as_of``, or a second after the last run if that is later."""
    zoned = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    own = int(zoned.timestamp() * 1000)
    gone = [int(name.removeprefix("at=")) for name in folders(spark, _ticks(path)) if name.startswith("at=")]
    return max([own, *(t + 1000 for t in gone)])


def _write_tick(spark: SparkSession, path: str, tick: int) -> None:
    spark.range(1).select(F.timestamp_millis(F.lit(tick)).alias("tick")).coalesce(1).write.mode("overwrite").parquet(f"{_ticks(path)}/at={tick}")


_INPUT = ("tick", "id", "row", "kind", "tried_at")


def retry_failures(
    spark: SparkSession,
    path: str,
    given: T.StructType,
    tick: int,
    attempt: Callable[[DataFrame], DataFrame],
    retries: Retries,
    retire: bool = True,
) -> None:
    """Keep what failed in the batches below ``path`` and try what is due at ``tick``.

    The batches hold the failed rows as a struct ``given`` and ``tried_at``, in a folder ``status=failed`` each;
    ``attempt`` maps such rows to columns with a ``status`` (ok or failed) and the row as ``given``.
    With ``retire`` the folders of failed rows are removed once they are state.
    """
    _write_tick(spark, path, tick)
    spark.createDataFrame([], given).write.mode("overwrite").parquet(f"{path}__retry/given")
    failed_folders = [f"batch_id={n}" for n in _batches(spark, path)]
    none = F.lit(None)

    def source(schema: T.StructType | str, where: str) -> DataFrame:
        return spark.readStream.schema(schema).option("ignoreMissingFiles", True).parquet(where)

    clock = source("tick timestamp", f"{_ticks(path)}/at=*").withWatermark("tick", "0 seconds")
    ticks = clock.select("tick", F.lit("").alias("id"), none.cast("string").alias("row"), F.lit(OK).alias("kind"), none.cast("long").alias("tried_at"))
    failures = source(T.StructType([T.StructField("given", given), T.StructField("tried_at", T.LongType())]), f"{path}/batch_id=*/status={FAILED}")
    failures = failures.select("tried_at", as_text(F.col("given")).alias("row"))
    kept = failures.select(none.cast("timestamp").alias("tick"), F.sha2("row", 256).alias("id"), "row", F.lit(FAILED).alias("kind"), "tried_at")
    good = source("id string", f"{attempts_path(path)}/batch_id=*/status={OK}")
    settled = good.select(none.cast("timestamp").alias("tick"), "id", none.cast("string").alias("row"), F.lit(OK).alias("kind"), none.cast("long").alias("tried_at"))
    told = ticks.unionByName(kept).unionByName(settled).select(*_INPUT)
    due = told.groupBy("id").transformWithState(Pending(retries), "id string, row string, last boolean", "append", "eventTime")

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(from_text(F.col("row"), given).alias("g"), F.col("id").alias("__id"), F.col("last").alias("__last")).select("g.*", "__id", "__last")
        tried = attempt(rows)
        status = F.when((F.col("status") == FAILED) & F.col("given.__last"), EXPIRED).otherwise(F.col("status"))
        plain = F.struct(*[F.col("given")[f].alias(f) for f in given.names])
        out = tried.select(*[c for c in tried.columns if c not in ("given", "status")], F.col("given.__id").alias("id"), plain.alias("given"), status.alias("status"))
        write_batch(out, attempts_path(path), batch_id, "status")

    with rocksdb(spark):
        drain_to_batches(due, load, _state(path))
    if retire:
        for name in failed_folders:
            remove(spark, f"{path}/{name}/status={FAILED}")
        for name in folders(spark, _ticks(path)):
            if name != f"at={tick}":
                remove(spark, f"{_ticks(path)}/{name}")


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("batch_id=")) for name in folders(spark, path) if name.startswith("batch_id="))


def given_schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(f"{path}__retry/given").schema


def pending(spark: SparkSession, path: str) -> DataFrame:
    """Rows that wait for their next attempt, with ``failures``, read from the state itself.

    An attempt that went well is taken out of the state by the next run; its row waits no more.
    """
    rows = spark.read.format("statestore").option("stateVarName", "pending").load(_state(path))
    waiting = rows.select(F.col("key.id").alias("id"), F.col("value.row").alias("row"), F.col("value.failures").alias("failures"))
    if has_batches(spark, attempts_path(path)):
        tried = spark.read.schema("id string, status string").parquet(attempts_path(path))
        waiting = waiting.join(tried.filter(F.col("status") == OK).select("id"), "id", "left_anti")
    return waiting.select(from_text(F.col("row"), given_schema(spark, path)).alias("g"), "failures").select("g.*", "failures")
