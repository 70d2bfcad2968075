"""Packing of documents into sequences of bounded length by best-two-fit.

Documents are tokenized in tasks and cut into pieces; only documents longer than a sequence are cut.
How pieces are put together depends on their lengths alone, so the plan is made over the number of
pieces of each length: at most ``limit`` numbers, whatever the size of the corpus. A sequence is
filled greedily, the longest piece that fits first; then its smallest piece gives way to two
unpacked ones if these fill the widened gap better. The same filling is repeated for as many
sequences as the lengths allow. Every piece has a rank among those of its length, and the plan turns
length and rank into sequence and place, in tasks again.

Ranks come from a count per written partition and length, summed up over the partitions, so a length
that a third of all pieces share is never gathered in one task.

Defined cases: a null text is an empty one; an empty document is its end token alone. Repeated rows
are packed as often as they occur. An empty table gives no sequences.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.llm.arrays import slices
from weirstone.session import fresh_dir

LIMIT = 2048


@cache
def encoding(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def cut(length: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: whole, or a rest and then full ones."""
    if length <= limit:
        return [(0, length)]
    rest = length % limit
    return ([(0, rest)] if rest else []) + [(at, limit) for at in range(rest, length, limit)]


def pieces(docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int], end: int = 0, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenized pieces: key, piece, start, length, checksum of the ids, partition and rank in it."""
    marks = tuple(special.items())
    selected = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", selected.schema["doc_id"].dataType), *(T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32", "part", "place"))])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoding(ranks_path, pattern, marks)
        part = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        tail = np.array([end], "<u4")
        for batch in batches:
            for first, last in slices(batch.column(1)):
                rows = []
                for i, content in enumerate(batch.column(1).slice(first, last - first).to_pylist(), first):
                    ids = np.concatenate([coder.encode_to_numpy(content or "", allowed_special="all").astype("<u4"), tail])
                    for n, (start, length) in enumerate(cut(len(ids), limit)):
                        rows.append((i, n, start, length, zlib.crc32(ids[start : start + length].tobytes()), part, seen[length]))
                        seen[length] += 1
                if rows:
                    row, *others = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *(pa.array(x) for x in others)], names=schema.names)

    return selected.mapInArrow(tokenize, schema)


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[list[tuple[int, int]], int]]:
    """Fillings and how many sequences have each, from the number of pieces of each length.

    A filling is a list of (length, pieces of that length in the sequence).
    """
    left = np.zeros(limit + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    fillings = []

    def longest(gap: int) -> int:
        found = np.flatnonzero(left[: gap + 1] > used[: gap + 1])
        return int(found[-1]) if len(found) else 0

    top = limit
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return fillings
        used = np.zeros(limit + 1, np.int64)
        gap = limit
        while gap and (length := longest(gap)):
            fits = min(gap // length, int(left[length] - used[length]))
            used[length] += fits
            gap -= fits * length
        filled = np.flatnonzero(used)
        smallest = int(filled[0])
        if gap and used.sum() > 1:
            used[smallest] -= 1
            best = _two(left - used, gap + smallest, smallest)
            if best:
                used[best[0]] += 1
                used[best[1]] += 1
            else:
                used[smallest] += 1
        filled = np.flatnonzero(used)
        repeats = int((left[filled] // used[filled]).min())
        left[filled] -= repeats * used[filled]
        fillings.append(([(int(n), int(used[n])) for n in filled[::-1]], repeats))


def _two(free: np.ndarray, room: int, beaten: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum within ``room`` that is over ``beaten``."""
    lengths = np.flatnonzero(free > 0)
    lengths = lengths[(lengths > 0) & (lengths < room)]
    if not len(lengths):
        return None
    other = np.searchsorted(lengths, room - lengths, side="right") - 1
    valid = other >= 0
    partner = np.where(valid, lengths[np.maximum(other, 0)], 0)
    twice = valid & (partner == lengths) & (free[lengths] < 2)
    partner = np.where(twice, np.where(other > 0, lengths[np.maximum(other - 1, 0)], 0), partner)
    total = np.where(partner > 0, lengths + partner, 0)
    best = int(total.argmax())
    return (int(lengths[best]), int(partner[best])) if total[best] > beaten else None


def assignments(fillings: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int]]:
    """For each length the ranks of its pieces in blocks: (length, first rank, first sequence,
    pieces in a sequence, first offset). Ranks and sequences go up together within a block."""
    rank: dict[int, int] = {}
    blocks, sequence = [], 0
    for filling, repeats in fillings:
        offset = 0
        for length, each in filling:
            blocks.append((length, rank.get(length, 0), sequence, each, offset))
            rank[length] = rank.get(length, 0) + each * repeats
            offset += length * each
        sequence += repeats
    return blocks


def pack(docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int], end: int = 0, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "pieces")
    pieces(docs, ranks_path, pattern, special, end, limit, key, text).write.parquet(path)
    cut_up = spark.read.parquet(path)
    by_part = cut_up.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `limit` rows at most
    blocks = sorted(assignments(plan(totals, limit)))
    table = np.array(blocks, np.int64).reshape(-1, 5)
    span = np.int64(1) << 50

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        lengths, ranks = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        block = table[np.searchsorted(table[:, 0] * span + table[:, 1], lengths * span + ranks, side="right") - 1]
        nth = ranks - block[:, 1]
        return pa.StructArray.from_arrays([pa.array(block[:, 2] + nth // block[:, 3]), pa.array(block[:, 4] + nth % block[:, 3] * lengths)], ["sequence_id", "offset"])

    ranked = cut_up.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    placed = ranked.withColumn("at", place("length", "rank"))
    return placed.select(F.col("doc_id").alias(key), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
