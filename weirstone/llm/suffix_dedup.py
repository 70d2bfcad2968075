"""Repeated byte strings by a distributed difference cover of suffixes.

A start ``p`` repeats if the ``LENGTH`` bytes from ``p`` on begin anywhere else too, in any document.
Every byte that such a string covers is removed, in all places.

The sample of suffixes is a difference cover by content (``anchors``): equal strings have a sampled
position at the same distance from their start, some 30 bytes apart where a cover by remainders
would sample two positions of three. The steps are those of a difference-cover suffix sort, cut off
where names stand for ``LENGTH`` bytes, since longer prefixes decide nothing:

1. Sampled suffixes are named by the bytes that all starts of the anchor have in common. Names that
   occur once belong to suffixes without a long common prefix; these are out.
2. Names are extended to the whole context of the anchor, the union of its starts. A context that
   occurs twice decides all its starts at once, however many copies there are.
3. The remaining suffixes, those of the starts whose context is unique, are merged in: sorted by
   their distance to the anchor and their own bytes, within groups that share the 133 bytes around
   the anchor. Adjacent equal prefixes of ``LENGTH`` bytes are repeats.

Copies of a context send one representative into step 3. Names are 64-bit hashes of the bytes they
stand for; all counts are made with partial sums before a shuffle, and a group of step 3 holds only
different contexts. Texts are shuffled twice, compressed: once for the contexts of step 3, once for
the result.

Defined cases: a null text is an empty one; texts below ``LENGTH`` bytes have no start and keep all
bytes. Overlapping starts count, also within one document: a run of one letter repeats itself.
Repeated rows repeat each other. Very long texts are cut into overlapping parts. An empty table
gives no row. As text, what is left drops a letter of which a byte was removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.llm.anchors import WINDOW, anchor_ranges
from weirstone.llm.arrays import Prefixes, mix, release, slices, text_buffer
from weirstone.session import fresh_dir

LENGTH = 200
COMMON = LENGTH - WINDOW + 1  # bytes from the anchor on that all of its starts cover
HALF = WINDOW // 2  # starts nearer to the anchor than this share the bytes after it, the others those around it
PART = 8 << 20
SLICE = 1 << 17  # bytes of text at once: a score of arrays of numbers is made over them
KNOWN_KEYS = 100_000  # texts that a task remembers to have seen; one more copy does no harm

LONG = T.LongType()


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Bytes, offsets, first row and first byte of parts below the limit of ``anchor_ranges``."""
    if len(data) <= PART:
        yield data, offsets, 0, 0
        return
    for row in range(len(offsets) - 1):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for at in range(a, max(b, a + 1), PART):
            stop = min(b, at + PART + LENGTH - 1)
            yield data[at:stop], np.array([0, stop - at]), row, at - a


def sampled(texts: DataFrame, full: bool) -> DataFrame:
    """Names of the anchors of every text; with ``full`` also context, text key, place and starts."""
    fields = [T.StructField("name", LONG)]
    if full:
        fields += [T.StructField("context", LONG), T.StructField("th", LONG), T.StructField("place", LONG)]
    schema = T.StructType(fields)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1), SLICE):
                data, offsets = text_buffer(batch.column(1).slice(first, last - first))
                keys = batch.column(0).slice(first, last - first).to_numpy()
                for part, bounds, row0, base in _parts(data, offsets):
                    hashes = Prefixes(part)
                    row, anchor, low, high = anchor_ranges(part, bounds, LENGTH, hashes)
                    columns = [pa.array(hashes.windows(anchor, anchor + COMMON).view(np.int64))]
                    if full:
                        inner = hashes.windows(low, high + LENGTH) + (anchor - low).astype(np.uint64)
                        begin = anchor - bounds[row] + base
                        columns += [pa.array(mix(inner).view(np.int64)), pa.array(keys[row + row0]), pa.array(packed(begin, anchor - low, anchor - high))]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            release()

    return texts.mapInArrow(find, schema)


def packed(anchor: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Place of an anchor and the distances of its first and last start in one number."""
    return (anchor << 16) | (far << 8) | near


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, (place >> 8) & 255, place & 255


def _contexts(joined: DataFrame) -> DataFrame:
    """Bytes of the contexts to merge: group, text key, first start, its distance, weight, bytes."""
    schema = T.StructType([T.StructField(n, LONG) for n in ("group", "th", "start", "distance", "weight")] + [T.StructField("bytes", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        seen: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            for i in range(len(batch)):
                key = batch.column(0)[i].as_py()
                if key in seen:  # a copy of the same text
                    continue
                seen.add(key)
                if len(seen) > KNOWN_KEYS:
                    seen.clear()
                raw = unpack.decompress(batch.column(1)[i].as_py())
                place, weight = (batch.column(2)[i].values.field(n).to_numpy() for n in ("place", "weight"))
                anchor, far, near = unpacked(place)
                hashes = Prefixes(np.frombuffer(raw, np.uint8))
                for half, from_, to in ((0, np.minimum(far, HALF - 1), near), (1, far, np.maximum(near, HALF))):
                    some = np.flatnonzero(from_ >= to)
                    left = anchor[some] - (HALF if half else 0)
                    group = hashes.windows(left, left + LENGTH - HALF + 1) + np.uint64(half)
                    for g, a, d, e, w in zip(group.view(np.int64).tolist(), anchor[some].tolist(), from_[some].tolist(), to[some].tolist(), weight[some].tolist(), strict=True):
                        rows.append((g, key, a - d, d, w, raw[a - d : a - e + LENGTH]))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.binary()], strict=True)], names=schema.names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.binary()], strict=True)], names=schema.names)
            release()

    return joined.mapInArrow(cut, schema)


def _merged(contexts: DataFrame) -> DataFrame:
    """Starts of single contexts that another context of their group repeats, as ranges."""
    schema = T.StructType([T.StructField(n, LONG) for n in ("th", "low", "high")])

    def repeats(table: pa.Table) -> pa.RecordBatch:
        group, th, start, distance, weight = (table[n].to_numpy() for n in ("group", "th", "start", "distance", "weight"))
        column = pa.concat_arrays(table["bytes"].chunks) if len(table) else pa.array([], pa.binary())
        data, offsets = text_buffer(column.cast(pa.large_binary()).view(pa.large_string()))
        hashes = Prefixes(data)
        made = np.diff(offsets) - LENGTH + 1
        row = np.repeat(np.arange(len(table)), made)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
        begin = offsets[:-1][row] + nth
        # the merged order: group, distance to the anchor, bytes
        key = mix(hashes.windows(begin, begin + LENGTH) + (distance[row] - nth).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ group[row].view(np.uint64)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        equal = np.zeros(len(row), bool)
        equal[order[1:][same]] = True
        equal[order[:-1][same]] = True
        hit = np.flatnonzero(equal & (weight[row] == 1))
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) > 1) | (row[hit][1:] != row[hit][:-1])
        first = hit[new]
        last = hit[np.concatenate([np.flatnonzero(new)[1:], [len(hit)]]).astype(np.int64) - 1] if len(hit) else hit
        return pa.RecordBatch.from_arrays([pa.array(th[row[first]]), pa.array(start[row[first]] + nth[first]), pa.array(start[row[last]] + nth[last])], names=schema.names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # sorted by group; the last one may go on in the next batch
            for at in range(0, len(batch), 4096):
                held.append(batch.slice(at, 4096))
                table = pa.Table.from_batches(held)
                group = table["group"].to_numpy()
                whole = int(np.argmax(group == group[-1]))
                if whole:
                    yield repeats(table.slice(0, whole))
                    held = table.slice(whole).to_batches()
            release()
        if held:
            yield repeats(pa.Table.from_batches(held))
            release()

    return contexts.repartition("group").sortWithinPartitions("group").mapInArrow(merge, schema)


RESULT = T.StructType([T.StructField("n_removed", LONG), T.StructField("n_spans", LONG), T.StructField("kept_sha256", T.StringType()), T.StructField("n_kept", LONG), T.StructField("kept", T.StringType())])


def _removal(with_text: bool):
    """What is removed and what is left of a text; with ``with_text`` also its letters, in the same
    worker: a second function over them would have a second one in each task."""

    @F.arrow_udf(RESULT)
    def remove(text: pa.Array, ranges: pa.Array) -> pa.Array:
        unpack = zstandard.ZstdDecompressor()
        rows = []
        for i in range(len(text)):
            raw = unpack.decompress(text[i].as_py())
            starts = ranges[i].as_py() or []
            kept, at, removed, spans = [], 0, 0, 0
            merged: list[list[int]] = []
            for r in sorted((r["low"], r["high"]) for r in starts):
                low, high = r[0], r[1] + LENGTH
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                kept.append(raw[at:low])
                removed += high - low
                spans += 1
                at = high
            kept.append(raw[at:])
            left = b"".join(kept)
            rows.append((removed, spans, hashlib.sha256(left).hexdigest(), len(left), left.decode("utf-8", "ignore") if with_text else None))
        columns = zip(*rows, strict=True) if rows else [[], [], [], [], []]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        made = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], RESULT.names)
        del rows, columns
        release()
        return made

    return remove.asNondeterministic()  # else Spark asks again for the filter, in one more worker for each task


@F.arrow_udf(T.BinaryType())
def _compressed(text: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=1)
    made = pa.array([pack.compress(t.encode()) for t in text.to_pylist()], pa.binary())
    release()
    return made


def _keep(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_starts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``th`` (key of a text) and its ranges of repeated starts, as an array of low and high."""
    texts = docs.where(F.octet_length(text) >= LENGTH).select(F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    common = sampled(texts, full=False).groupBy("name").count().where("count > 1").select("name")
    suffixes = _keep(sampled(texts, full=True).join(common, "name", "left_semi"), "suffixes")
    classes = suffixes.groupBy("context").agg(F.count("*").alias("n"), F.min("name").alias("name"), F.min(F.struct("th", "place")).alias("one"))
    classes = _keep(classes, "contexts")
    several = classes.where("n > 1").select("context")
    decided = suffixes.join(several, "context", "left_semi").select("th", "place")
    anchor, far, near = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(255))
    decided = decided.distinct().select("th", (anchor - far).alias("low"), (anchor - near).alias("high"))
    open_groups = classes.groupBy("name").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1").select("name")
    wanted = classes.join(open_groups, "name", "left_semi").select("one.th", F.struct(F.col("one.place").alias("place"), F.least("n", F.lit(2)).cast("long").alias("weight")).alias("spot"))
    lists = wanted.groupBy("th").agg(F.collect_list("spot").alias("spots"))  # anchors of one text
    joined = texts.select("th", _compressed("text").alias("zip")).join(lists, "th").select("th", "zip", "spots")
    merged = _merged(_contexts(joined))
    return decided.unionAll(merged).groupBy("th").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256."""
    ranges = _keep(repeated_starts(docs, text), "repeats")
    whole = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("th"), F.octet_length(whole).cast("long").alias("n_bytes"), _compressed(whole).alias("zip"))
    cleaned = given.join(ranges, "th", "left").select("k", "n_bytes", _removal(False)("zip", "ranges").alias("r"))
    return cleaned.select(F.col("k").alias(key), "n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256")


def without_repeats(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; null texts stay null. A document of
    which nothing is left goes. ``length`` names a column that holds the length in characters."""
    columns = docs.columns
    ranges = _keep(repeated_starts(docs, text), "repeats")
    free = "_" + max(columns, key=len)
    others = F.struct(*(F.col(c) for c in columns if c != text)).alias("rest")
    given = docs.select(others, F.col(text).isNull().alias("no_text"), F.xxhash64(text).alias("th"), _compressed(F.coalesce(F.col(text), F.lit(""))).alias("zip"))
    cleaned = given.join(ranges, "th", "left").select("rest", "no_text", _removal(True)("zip", "ranges").alias("r"))
    kept = cleaned.where("r.n_removed = 0 or r.n_kept > 0").select("rest", F.when(~F.col("no_text"), F.col("r.kept")).alias(free))
    made = {c: F.col(free) if c == text else F.col("rest")[c] for c in columns}
    if length in columns and length != text:
        made[length] = F.when(F.col(free).isNotNull(), F.length(free).cast(docs.schema[length].dataType)).otherwise(F.col("rest")[length])
    return kept.select(*(made[c].alias(c) for c in columns))
