"""A streaming source over bucket folders, drained like a queue.

Below the root lies a folder per bucket, named by the bucket (plain, or ``bucket_name=`` with the name
percent-encoded as partition folders have it), with Parquet files of ``event_key`` and ``message``.
A batch takes the oldest unread rows of closed buckets, at most ``limit`` of them; the bucket that
is open at ``as_of`` (by default the time of the planning) waits. A micro-batch is one such batch, or
up to ``batches`` of them where more are waiting: so a backlog takes fewer turns, each of them a
parallel job, and column ``batch`` tells the batches apart.

The source keeps plans of its own: a plan lists files with a first and a last row and the number of
their batch, and is named by its last batch; offset n means "all batches up to n". A plan is written
before its number is given out, so a batch that is repeated after a crash reads the same rows, and
rows are in one batch only. Once Spark has committed a micro-batch, its plans are forgotten and files that have been read to the end are removed, unless the option
``keep`` is set: then their names stay in the plans. So a file that comes late into an old bucket is
read like any other, and neither plans nor listings grow with the past. One query drains a root.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from weirstone.sources.buckets import BUCKET_PREFIX, bucket_events
from weirstone.sources.named_files import qualified

ROWS = "event_key string, message string, bucket_name string, batch long"
PLANS = "_plans"


@dataclass
class Part(InputPartition):
    """Ranges (file, bucket, first row, end) that one task reads, and the batch of each."""

    ranges: list[tuple[str, str, int, int]]
    numbers: list[int]


class BucketReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.limit = options["root"], int(options.get("limit") or 1000)
        self.minutes, self.as_of = int(options.get("minutes") or 5), options.get("as_of")
        self.keep, self.tasks = options.get("keep") == "true", int(options.get("tasks") or 16)
        self.batches = int(options.get("batches") or 1)

    # Offsets -----------------------------------------------------------------------------------

    def initialOffset(self) -> dict:
        return {"plan": 0}

    def latestOffset(self) -> dict:
        """The last batch's number, after a further plan has been made if there is something to read."""
        plans = self._plans()
        last = max(plans, default=0)
        taken: dict[str, int] = {}
        for n in plans:
            for file, _, _, end, _ in self._plan(n):
                taken[file] = max(taken.get(file, 0), end)
        found, room = [], self.limit * self.batches
        for bucket, file in self._closed_files():
            if room <= 0:
                break
            first, rows = taken.get(file, 0), self._rows(file)
            while first < rows and room > 0:  # up to the end of the file or of the batch
                end = min(rows, first + (room - 1) % self.limit + 1)
                found.append([file, bucket, first, end, last + self.batches - (room - 1) // self.limit])
                room -= end - first
                first = end
        if not found:
            return {"plan": last}
        self._write_plan(found[-1][4], found)
        return {"plan": found[-1][4]}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """Neighbouring ranges share a task, so that a batch of many small files is not as many tasks."""
        entries = [tuple(entry) for n in self._plans() if start["plan"] < n <= end["plan"] for entry in self._plan(n)]
        missing = set(range(start["plan"] + 1, end["plan"] + 1)) - {entry[4] for entry in entries}
        if missing:
            raise FileNotFoundError(f"no plan of batch {min(missing)} below {self.root}")
        rows = sum(entry[3] - entry[2] for entry in entries)
        parts: list[Part] = []
        held = 0
        for entry in entries:
            if not parts or held * self.tasks >= rows:
                parts.append(Part([], []))
                held = 0
            parts[-1].ranges.append(entry[:4])
            parts[-1].numbers.append(entry[4])
            held += entry[3] - entry[2]
        return parts

    def commit(self, end: dict) -> None:
        """Forget the plans up to ``end``; the last one stays for its number and for files read in part."""
        store, root = self._store()
        done = [n for n in self._plans() if n <= end["plan"]]
        reached: dict[str, list] = {}
        for n in done:
            for entry in self._plan(n):
                reached[entry[0]] = entry
        later = {entry[0] for n in self._plans() if n > end["plan"] for entry in self._plan(n)}
        left = []
        for file, entry in reached.items():
            there = store.get_file_info(posixpath.join(root, file)).type == fs.FileType.File
            if there and (self.keep or entry[3] < self._rows(file)):
                left.append(entry)
            elif there and file not in later:
                store.delete_file(posixpath.join(root, file))
        if done:
            self._write_plan(done[-1], left)
            for n in done[:-1]:
                store.delete_file(self._plan_path(n))

    # Rows --------------------------------------------------------------------------------------

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """Neighbouring ranges of a file are read in one go, and of the file only their row groups."""
        store, root = self._store()
        for file, group in groupby(zip(partition.ranges, partition.numbers, strict=True), key=lambda one: one[0][0]):
            ranges = [(bucket, first, end, number) for (_, bucket, first, end), number in group]
            with store.open_input_file(posixpath.join(root, file)) as source:
                parquet = pq.ParquetFile(source)
                groups, at, after = [], 0, 0
                for n in range(parquet.num_row_groups):
                    begin, after = after, after + parquet.metadata.row_group(n).num_rows
                    if after > ranges[0][1] and begin < ranges[-1][2]:
                        at = at if groups else begin
                        groups.append(n)
                for batch in parquet.iter_batches(row_groups=groups, columns=["event_key", "message"]):
                    for bucket, begin, end, number in ranges:
                        first, last = max(begin - at, 0), min(end - at, len(batch))
                        if first < last:
                            part = batch.slice(first, last - first)
                            text = [part.column(name).cast(pa.string()) for name in ("event_key", "message")]
                            told = [pa.array([bucket] * len(part)), pa.array([number] * len(part), pa.int64())]
                            yield pa.RecordBatch.from_arrays([*text, *told], names=["event_key", "message", "bucket_name", "batch"])
                    at += len(batch)
                    if at >= ranges[-1][2]:
                        break

    # Storage -----------------------------------------------------------------------------------

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def _closed_files(self) -> Iterator[tuple[str, str]]:
        """(bucket, file) of all buckets but the open one, by bucket and name."""
        store, root = self._store()
        now = dt.datetime.fromisoformat(self.as_of) if self.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        start = now.replace(minute=now.minute // self.minutes * self.minutes, second=0, microsecond=0)
        is_open = f"{BUCKET_PREFIX}:{start:%Y-%m-%dT%H:%M:%SZ}"
        buckets = []
        for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            name = unquote(info.base_name.removeprefix("bucket_name="))
            if info.type == fs.FileType.Directory and name.startswith(f"{BUCKET_PREFIX}:") and name != is_open:
                buckets.append((name, info.base_name))
        for name, folder in sorted(buckets):
            files = store.get_file_info(fs.FileSelector(posixpath.join(root, folder)))
            for file in sorted(f.base_name for f in files if f.type == fs.FileType.File and f.base_name[0] not in "_."):
                yield name, posixpath.join(folder, file)

    def _rows(self, file: str) -> int:
        store, root = self._store()
        with store.open_input_file(posixpath.join(root, file)) as source:
            return pq.read_metadata(source).num_rows

    def _plan_path(self, n: int) -> str:
        return posixpath.join(self._store()[1], PLANS, f"{n}.json")

    def _plans(self) -> list[int]:
        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(posixpath.join(root, PLANS), allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))

    def _plan(self, n: int) -> list[list]:
        store, _ = self._store()
        with store.open_input_stream(self._plan_path(n)) as source:
            return [[*entry, n][:5] for entry in json.loads(source.read())]  # an earlier plan was one batch

    def _write_plan(self, n: int, entries: list[list]) -> None:
        """Written beside and moved, so that a plan is there as a whole or not at all."""
        store, root = self._store()
        store.create_dir(posixpath.join(root, PLANS))
        beside = f"{self._plan_path(n)}.new"
        with store.open_output_stream(beside) as out:
            out.write(json.dumps(entries).encode())
        store.move(beside, self._plan_path(n))


class Buckets(DataSource):
    """Read-only stream; options ``root`` (a URI), ``limit``, ``minutes``, ``as_of``, ``keep``, ``batches`` and ``tasks`` (of a micro-batch, about)."""

    @classmethod
    def name(cls) -> str:
        return "event_buckets"

    def schema(self) -> str:
        return ROWS

    def streamReader(self, schema: StructType) -> BucketReader:
        return BucketReader(dict(self.options))


def stream_buckets(
    spark: SparkSession, root: str, limit: int = 1000, as_of: dt.datetime | None = None, minutes: int = 5, keep: bool = False, batches: int | None = None
) -> DataFrame:
    """(event_key, message, bucket_name, partition_dt) of closed buckets, at most ``limit`` rows per batch.

    A micro-batch is one batch; with ``batches`` it is up to so many, told apart by a column ``batch``.
    """
    spark.dataSource.register(Buckets)
    reader = spark.readStream.format("event_buckets").option("root", qualified(spark, root)).option("limit", limit).option("minutes", minutes)
    if as_of is not None:
        reader = reader.option("as_of", as_of.isoformat())
    rows = bucket_events(reader.option("keep", str(keep).lower()).option("batches", batches or 1).load())
    return rows if batches else rows.drop("batch")


def drain(query_of: DataFrame, sink, checkpoint: str) -> StreamingQuery:
    """Hand batches to ``sink`` until every closed bucket is empty.

    A source that plans batch by batch is drained by a query that runs until there is nothing new.
    """
    query = query_of.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
