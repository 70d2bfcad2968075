"""Objects under exact names, written by the executors and published when the whole job has ended.

Rows are (path, position, tie, line): a line of the object ``path``, which is relative to the root. All rows
of an object come to one task, in order, and are streamed into a file of that attempt below
``_staged``; no task holds an object. The driver gets one message per task with the names alone. On
commit it checks that no object was written twice and moves the files to their names, those
that are called latest after all others. A failed job publishes nothing, and a repeated one replaces what the first
left. The root is in storage that ``pyarrow.fs`` reaches: a mounted folder, hdfs, s3, gs.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

LINES = "path string, line string"
STAGED = "_staged"


@dataclass
class Written(WriterCommitMessage):
    """(staged file, path) of each object of a task."""

    files: list[tuple[str, str]]


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, root: str, run: str):
        self.root, self.run = root, run

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = self._place()
        task = TaskContext.get()
        folder = posixpath.join(root, STAGED, self.run, f"{task.partitionId()}-{task.taskAttemptId()}")
        files: list[tuple[str, str]] = []
        current, out = None, None
        for batch in iterator:
            for path, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path != current:
                    if out is not None:
                        out.close()
                    if not files:
                        store.create_dir(folder)
                    files.append((posixpath.join(folder, str(len(files))), checked_path(path)))
                    current, out = path, store.open_output_stream(files[-1][0])
                out.write(f"{line}\n".encode())
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        store, root = self._place()
        files = [f for m in messages if m is not None for f in m.files]
        doubled = len(files) - len({path for _, path in files})
        if doubled:
            self.abort(messages)
            raise ValueError(f"{doubled} objects were written more than once")
        made = set()
        for staged, path in sorted(files, key=lambda f: (posixpath.basename(f[1]).startswith("latest"), f[1])):
            target = posixpath.join(root, path)
            parent = posixpath.dirname(target)
            if parent not in made:
                store.create_dir(parent)
                made.add(parent)
            if not isinstance(store, fs.LocalFileSystem) and store.get_file_info(target).type == fs.FileType.File:
                store.delete_file(target)  # a local move replaces, others may not
            store.move(staged, target)
        self.abort(messages)

    def abort(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        """Remove the files of all attempts of this run."""
        store, root = self._place()
        folder = posixpath.join(root, STAGED, self.run)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class NamedFiles(DataSource):
    """Write-only: ``df.write.format("named_files").option("root", ...)`` with rows of ``LINES`` sorted by object."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return LINES

    def writer(self, schema: T.StructType, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(self.options["root"], self.options["run"])


def checked_path(path: str | None) -> str:
    parts = (path or "").split("/")
    if not path or path.startswith("/") or any(p in ("", ".", "..", STAGED) for p in parts):
        raise ValueError(f"no name for an object: {path!r}")
    return path


def qualified(spark: SparkSession, root: str) -> str:
    """The root as a URI: a path without scheme is one of the default file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_objects(lines: DataFrame, root: str) -> None:
    """Publish the objects of (path, position, tie, line) below ``root``, all or none."""
    spark = lines.sparkSession
    spark.dataSource.register(NamedFiles)
    dealt = lines.repartition("path").sortWithinPartitions("path", "position", "tie").select("path", "line")
    dealt.write.format("named_files").mode("append").option("root", qualified(spark, root)).option("run", uuid.uuid4().hex).save()


def read_objects(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, line) of the objects whose path matches the glob ``pattern``, an object's whole text as ``line``."""
    at = qualified(spark, root).rstrip("/")
    rows = spark.read.text(f"{at}/{pattern}", wholetext=True)
    prefix = F.regexp_replace(F.lit(at), "^file:/+", "file:/")
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    return rows.select(F.substring(path, F.length(prefix) + 2, F.length(path)).alias("path"), F.col("value").alias("line"))
