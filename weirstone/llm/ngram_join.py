"""Similarity join of documents on word n-grams with an R-tree over count vectors.

A document is the set of its distinct five-word shingles. Tokens are hashed into ``GROUPS`` groups,
and the number of a document's tokens in each group is a point. The summed minima of two points
bound the overlap of their sets from above; two documents are only compared if that bound reaches
the overlap that the threshold asks for.

The tree has three levels. Its top nodes are tokens: by the threshold, two similar sets share one of
the first ``n - ceil(0.8 n) + 1`` tokens of each under any fixed order of all tokens, so a document is
posted under these and under no others. Tokens that occur very often come last in that order, so
they are top nodes only of documents made of little else. Below a token its points are packed by
size into pages, each with the coordinate-wise maximum of its points; pages are paired only where
the bound of their maxima allows, points only where their own bound does. Surviving pairs are
verified on the texts.

Only components are asked for, so pairs are not listed in full. In each top node the first document
of every component so far is paired with the first of them all, in a few rounds; then the pages pair
what is still in different components. Two documents that stay apart have been compared, or a bound
keeps them apart. Equal texts are one point from the start.

What each step holds: hot tokens are at most ``HOT_TOKENS`` numbers, sent to all tasks; a node with
many points is split into chunks that are paired in separate tasks. The first pairs of a node are
drawn where its list is made, so lists are not shuffled for them. Of documents without a surviving
pair no text is shuffled, and later rounds read neither their lists nor their points: a filter of
``FILTER_BITS`` bits is sent to all tasks, which lets a few others pass by chance (more where it
fills up); exact joins follow. Texts are shuffled compressed.

Defined cases: null, empty and blank texts have no shingle and are linked with nothing; a text with
fewer than five words is one shingle. Repeated rows are one component. Rows with a null key belong
to components but never name one that has another key. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.llm.arrays import LOWER, SPACE, Lookup, Prefixes, release, shingles, slices, text_buffer, words
from weirstone.llm.graph import star_forest
from weirstone.session import fresh_dir

GROUPS = 256
FULL = 255  # a document with so many tokens in one group has no point: no bound applies to it
ROUNDS = 2
HOT_TOKENS = 200_000
HOT_FROM = 24
BLOCK_BYTES = 12 << 20
CHUNK = 1024
KNOWN_KEYS = 100_000  # texts that a task remembers to have seen; one more copy does no harm
PAGE = 32
FILTER_BITS = 1 << 25

LONG = T.LongType()


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and where each row's begin (n + 1 entries)."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    starts, stops, first = words(data, offsets, SPACE)
    found, row = shingles(Prefixes(data).windows(starts, stops), first)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[new], np.searchsorted(row[new], np.arange(len(column) + 1))


def alike(overlap, n_a, n_b):
    """Jaccard similarity of at least 0.8 in whole numbers, from the size of the overlap."""
    return 9 * overlap >= 4 * (n_a + n_b)


def points(texts: DataFrame) -> DataFrame:
    """From ``th`` and ``text``: one row per text with ``n`` and ``point``, and rows of frequent
    tokens with their number of documents within a block of text."""
    schema = T.StructType([T.StructField("th", LONG), T.StructField("n", LONG), T.StructField("point", T.BinaryType()), T.StructField("token", LONG), T.StructField("seen", LONG)])

    def frequent(blocks: list[np.ndarray]) -> pa.RecordBatch:
        token, seen = np.unique(np.concatenate(blocks), return_counts=True)
        token, seen = token[seen > 2], seen[seen > 2]
        none = pa.nulls(len(token), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.nulls(len(token), pa.binary()), pa.array(token.view(np.int64)), pa.array(seen)], names=schema.names)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        blocks: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for first, last in slices(batch.column(1)):
                keys = batch.column(0).slice(first, last - first)
                fresh = []
                for i, k in enumerate(keys.to_pylist()):
                    if k not in known:
                        known.add(k)
                        fresh.append(i)
                if len(known) > KNOWN_KEYS:
                    known.clear()
                if not fresh:
                    continue
                chosen = pa.array(fresh, pa.int64())
                found, begin = shingle_sets(batch.column(1).slice(first, last - first).take(chosen))
                n = np.diff(begin)
                row = np.repeat(np.arange(len(n)), n)
                counts = np.bincount(row * GROUPS + (found % np.uint64(GROUPS)).astype(np.int64), minlength=len(n) * GROUPS).reshape(-1, GROUPS)
                counts[counts.max(axis=1) >= FULL] = FULL
                vectors = [v.tobytes() for v in counts.astype(np.uint8)]
                none = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([keys.take(chosen), pa.array(n), pa.array(vectors, pa.binary()), none, none], names=schema.names)
                blocks.append(found)
                held += len(found)
                if held > BLOCK_BYTES // 8:
                    yield frequent(blocks)
                    blocks, held = [], 0
            release()
        if blocks:
            yield frequent(blocks)

    return texts.mapInArrow(measure, schema)


def postings(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """``token``, ``th`` and ``n`` for the leading tokens of every text."""
    schema = T.StructType([T.StructField("token", LONG), T.StructField("th", LONG), T.StructField("n", LONG)])
    shared = texts.sparkSession.sparkContext.broadcast(hot)  # HOT_TOKENS numbers at most

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = Lookup(shared.value)
        known: set[int] = set()
        for batch in batches:
            for first, last in slices(batch.column(1)):
                keys = batch.column(0).slice(first, last - first)
                fresh = []
                for i, k in enumerate(keys.to_pylist()):
                    if k not in known:
                        known.add(k)
                        fresh.append(i)
                if len(known) > KNOWN_KEYS:
                    known.clear()
                if not fresh:
                    continue
                chosen = pa.array(fresh, pa.int64())
                found, begin = shingle_sets(batch.column(1).slice(first, last - first).take(chosen))
                n = np.diff(begin)
                row = np.repeat(np.arange(len(n)), n)
                put_off = np.zeros(len(found), bool)
                put_off[late(found)[0]] = True
                order = np.lexsort((put_off, row))  # stable: by hash within
                place = np.arange(len(found)) - np.repeat(begin[:-1], n)
                leads = order[place < np.repeat(n - (4 * n + 4) // 5 + 1, n)]
                owner = row[leads]
                th = keys.take(chosen).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(found[leads].view(np.int64)), pa.array(th[owner]), pa.array(n[owner])], names=schema.names)
            release()

    return texts.mapInArrow(post, schema)


def point_rows(column: pa.Array) -> np.ndarray:
    """Points as a matrix of counts."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS).astype(np.int16)


@F.arrow_udf(T.BooleanType())
def bound_allows(point_a: pa.Array, n_a: pa.Array, point_b: pa.Array, n_b: pa.Array) -> pa.Array:
    """Whether the summed minima of two points allow the overlap that is asked for."""
    a, b = point_rows(point_a), point_rows(point_b)
    size_a, size_b = n_a.to_numpy(), n_b.to_numpy()
    none = (a[:, 0] == FULL) | (b[:, 0] == FULL)
    return pa.array(none | alike(np.minimum(a, b).sum(axis=1, dtype=np.int64), size_a, size_b))


@F.arrow_udf(T.BinaryType())
def compressed(text: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=1)
    return pa.array([pack.compress(t.encode()) for t in text.to_pylist()], pa.binary())


@F.arrow_udf(T.BooleanType())
def verified(zip_a: pa.Array, zip_b: pa.Array) -> pa.Array:
    """Whether the shingle sets of two texts have a Jaccard similarity of at least 0.8."""
    unpack = zstandard.ZstdDecompressor()
    result = []
    for first in range(0, len(zip_a), 256):
        texts = [pa.array([unpack.decompress(z).decode() for z in column.slice(first, 256).to_pylist()], pa.large_string()) for column in (zip_a, zip_b)]
        for a, b in zip(*map(_sets, texts), strict=True):
            result.append(bool(len(a) and len(b) and alike(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))))
    release()
    return pa.array(result, pa.bool_())


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    for first, last in slices(column):
        found, begin = shingle_sets(column.slice(first, last - first))
        yield from (found[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))


def page_pairs(th: np.ndarray, n: np.ndarray, point: np.ndarray, root: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points of ``left`` and ``right`` (positions, in order of size) from different
    components whose bounds allow a link."""
    same = left is right
    made_a, made_b = [], []
    pages_a = [left[i : i + PAGE] for i in range(0, len(left), PAGE)]
    pages_b = pages_a if same else [right[i : i + PAGE] for i in range(0, len(right), PAGE)]
    tops = np.stack([point[p].max(axis=0) for p in pages_b])
    free = tops.max(axis=1) == FULL
    low_b, high_b = np.array([n[p].min() for p in pages_b]), np.array([n[p].max() for p in pages_b])
    for x, a in enumerate(pages_a):
        low, high = n[a].min(), n[a].max()
        # sizes within a factor of 0.8, and maxima that allow the least overlap asked for
        top = point[a].max(axis=0)
        bound = alike(np.minimum(top, tops).sum(axis=1, dtype=np.int64), low, low_b) | free | (top.max() == FULL)
        near = (5 * high_b >= 4 * low) & (5 * high >= 4 * low_b) & bound
        for y in np.flatnonzero(near).tolist():
            if same and y < x:
                continue
            b = pages_b[y]
            overlap = np.minimum(point[a][:, None, :], point[b][None, :, :]).sum(axis=2, dtype=np.int64)
            none = (point[a][:, :1] == FULL) | (point[b][:, 0] == FULL)[None, :]
            sizes = (5 * n[a][:, None] >= 4 * n[b][None, :]) & (5 * n[b][None, :] >= 4 * n[a][:, None])
            ok = (none | alike(overlap, n[a][:, None], n[b][None, :])) & sizes & (root[a][:, None] != root[b][None, :])
            i, j = np.nonzero(ok)
            made_a.append(th[a[i]])
            made_b.append(th[b[j]])
    if not made_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(made_a), np.concatenate(made_b)
    return np.minimum(a, b), np.maximum(a, b)


def with_roots(lists: DataFrame, roots: DataFrame) -> DataFrame:
    return lists.join(roots.select(F.col("node").alias("th"), "root"), "th", "left").withColumn("root", F.coalesce("root", "th"))


def tree_pairs(named: DataFrame, measured: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of one top node, of different components, that the bounds allow.

    ``named`` has token, th, n and root. Nodes with the same documents are one node; nodes of one
    component have nothing to pair, and a document without another of a fitting size in its node
    has no partner there."""
    shape = named.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("th")).alias("x"), F.sum(F.xxhash64(F.lit(1), "th") % 1_000_000_007).alias("y"))
    unlike = shape.where((F.col("low") != F.col("high")) & (F.col("size") > 2))
    once = unlike.groupBy("size", "x", "y").agg(F.min("token").alias("token")).select("token")
    order = Window.partitionBy("token").orderBy("n", "th")
    fits = F.coalesce(5 * F.lag("n").over(order) >= 4 * F.col("n"), F.lit(False)) | F.coalesce(5 * F.col("n") >= 4 * F.lead("n").over(order), F.lit(False))
    members = named.join(once, "token", "left_semi").withColumn("fits", fits).where("fits")
    place = F.row_number().over(order) - 1
    chunked = _keep(members.select("token", "th", "n", "root", F.floor(place / CHUNK).cast("int").alias("chunk")), "chunks")
    chunks = chunked.groupBy("token").agg((F.max("chunk") + 1).alias("chunks"))
    units = chunked.join(chunks, "token").select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    units = units.join(measured.select("th", "point"), "th")
    units = units.select("token", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "th", "n", "point", "root")
    schema = T.StructType([T.StructField("a", LONG), T.StructField("b", LONG)])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(table: pa.Table) -> pa.RecordBatch:
            columns = {c: table[c].to_numpy() for c in ("token", "i", "j", "chunk", "th", "n", "root")}
            point = point_rows(table["point"])
            unit = np.ones(len(table), bool)
            for c in ("token", "i", "j"):
                unit[1:] &= columns[c][1:] == columns[c][:-1]
            edges = np.concatenate([np.flatnonzero(~unit | (np.arange(len(table)) == 0)), [len(table)]])
            made = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                rows = np.arange(a, b)[np.argsort(columns["n"][a:b], kind="stable")]
                if columns["i"][a] == columns["j"][a]:
                    left = right = rows
                else:
                    first = columns["chunk"][rows] == columns["i"][a]
                    left, right = rows[first], rows[~first]
                if len(left) and len(right):
                    made.append(page_pairs(columns["th"], columns["n"], point, columns["root"], left, right))
            found = np.unique(np.stack([np.concatenate(x) for x in zip(*made, strict=True)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:  # sorted: the last unit may go on in the next batch
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = table.slice(len(table) - 1)
            ends = np.ones(len(table), bool)
            for c in ("token", "i", "j"):
                ends &= table[c].to_numpy() == last[c][0].as_py()
            whole = int(np.argmax(ends)) if len(table) else 0
            if whole:
                yield solve(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held and sum(map(len, held)):
            yield solve(pa.Table.from_batches(held))

    dealt = units.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInArrow(pair, schema).where("a <> b").distinct()


def _keep(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def may_be_in(wanted: DataFrame) -> Column:
    """Whether ``th`` may be one of the keys in ``wanted``: true for all of them and few others."""
    spot = F.pmod("th", F.lit(FILTER_BITS)) + 1
    marked = wanted.select(F.bitmap_bucket_number(spot).alias("b"), F.bitmap_bit_position(spot).alias("p")).repartition("b")
    bits = np.zeros((FILTER_BITS // 32_768, 4096), np.uint8)
    # FILTER_BITS in all, fetched by one job: row by row would be a job for each shuffle partition
    made = marked.groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).toArrow()
    for b, row in zip(made["b"].to_pylist(), made["bits"].to_pylist(), strict=True):
        bits[b - 1] = np.frombuffer(row, np.uint8)
    shared = wanted.sparkSession.sparkContext.broadcast(bits.ravel())

    @F.arrow_udf(T.BooleanType())
    def may_be(keys: pa.Array) -> pa.Array:
        at = np.mod(keys.to_numpy(), FILTER_BITS)
        return pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return may_be(F.col("th"))


def fetch(texts: DataFrame, needed: DataFrame, wanted: Column) -> DataFrame:
    """Compressed texts of the keys in ``needed``, each once; ``wanted`` is their filter."""
    packed = texts.where(wanted).select("th", compressed("text").alias("zip"))
    return _keep(packed.join(needed, "th", "left_semi").dropDuplicates(["th"]), "texts")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("th")).unionAll(pairs.select("b")).distinct()


def confirm(pairs: DataFrame, some: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of which ``some`` has both texts, and whether these are similar (``linked``)."""
    both = pairs.join(some.select(F.col("th").alias("b"), F.col("zip").alias("zip_b")), "b").join(some.select(F.col("th").alias("a"), F.col("zip").alias("zip_a")), "a")
    return both.select("a", "b", verified("zip_a", "zip_b").alias("linked"))


def joined_by(seen: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Roots after the links in ``seen``; the links of earlier turns are in ``roots`` already."""
    links = seen.where("linked").select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star_forest(links if roots is None else roots.unionByName(links))


def leading(turn: int) -> Column:
    """The document that leads its group: in turn 0 the one with the smallest key, the same in all
    nodes. In other turns every node draws its own: two components of near copies meet in many
    nodes, with another pair in each."""
    rank = F.lit(0) if turn == 0 else F.xxhash64(F.lit(turn), "token", "th")
    return F.min(F.struct(rank.alias("rank"), "th", "n"))


def first_stars(lists: DataFrame, measured: DataFrame) -> DataFrame:
    """In each top node every document with the two that its list names."""
    return allowed(lists.select(F.explode(F.array("lead", "drawn")).alias("lead"), F.struct("th", "n").alias("one")), measured)


def star_pairs(named: DataFrame, measured: DataFrame, turn: int) -> DataFrame:
    """In each top node one document of every component with one that leads them all."""
    first = named.groupBy("token", "root").agg(leading(turn).alias("one"))
    return allowed(first.select(F.min("one").over(Window.partitionBy("token")).alias("lead"), "one"), measured)


def allowed(stars: DataFrame, measured: DataFrame) -> DataFrame:
    """Distinct pairs ``a``, ``b`` of ``lead`` and ``one`` that sizes and bounds allow."""
    pairs = stars.where("one.th <> lead.th and 5 * one.n >= 4 * lead.n and 5 * lead.n >= 4 * one.n")
    pairs = pairs.select(F.col("lead.th").alias("a"), F.col("lead.n").alias("n_a"), F.col("one.th").alias("b"), F.col("one.n").alias("n_b")).distinct()
    pairs = pairs.join(measured.select(F.col("th").alias("a"), F.col("point").alias("point_a")), "a").join(measured.select(F.col("th").alias("b"), F.col("point").alias("point_b")), "b")
    return pairs.where(bound_allows("point_a", "n_a", "point_b", "n_b")).select("a", "b")


def linked_texts(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``th``, ``n`` of every text, and ``node``, ``root`` of those that hang on another one."""
    texts = docs.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("th"), F.col(text).alias("text"))
    raw = _keep(points(texts), "points")
    measured = _keep(raw.where(F.col("th").isNotNull()).groupBy("th").agg(F.max("n").alias("n"), F.max("point").alias("point")), "measured")
    frequent = raw.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= HOT_FROM)
    hot = frequent.orderBy(F.col("seen").desc(), "token").limit(HOT_TOKENS).select("token").toArrow()["token"].to_numpy().view(np.uint64)
    node = Window.partitionBy("token")
    posted = postings(texts, hot).select("token", "th", "n", F.min("th").over(node).alias("first"), F.max("th").over(node).alias("last"))
    shared = posted.where("first <> last").select("token", "th", "n").distinct()
    # a node of two has one pair only: it draws no further one, and is done when that has been tried
    drawn = F.when(F.count("*").over(node) > 2, leading(ROUNDS + 1).over(node))
    lists = shared.select("token", "th", "n", leading(0).over(node).alias("lead"), drawn.alias("drawn"))
    lists = _keep(lists.select("token", "th", "n", *[F.when(F.col(c).isNotNull(), F.struct(f"{c}.th", f"{c}.n")).alias(c) for c in ("lead", "drawn")]), "nodes")
    nodes = lists.where("drawn is not null").select("token", "th", "n")
    fresh = _keep(first_stars(lists, measured), "pairs")
    wanted = may_be_in(ends(fresh))
    some = fetch(texts, ends(fresh), wanted)
    tried = roots = None
    for turn in range(1, ROUNDS + 1):
        seen = _keep(confirm(fresh, some), "links")
        tried = seen if tried is None else tried.unionByName(seen)
        roots = joined_by(seen, roots)
        if turn == ROUNDS:
            break
        # pairs whose texts are not there stay untried
        fresh = _keep(star_pairs(with_roots(nodes.where(wanted), roots), measured.where(wanted), turn).join(tried, ["a", "b"], "left_anti"), "pairs")
        if fresh.isEmpty():
            break
    # what is left in different components is paired in full, as far as the bounds allow
    left = _keep(tree_pairs(with_roots(nodes, roots), measured).join(tried, ["a", "b"], "left_anti"), "pairs")
    if not left.isEmpty():
        missing = ends(left).join(some, "th", "left_anti")
        if not missing.isEmpty():
            some = some.unionByName(fetch(texts, missing, may_be_in(missing)))
        roots = joined_by(_keep(confirm(left, some), "links"), roots)
    return measured.select("th", "n"), roots


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id."""
    measured, roots = linked_texts(docs, text)
    labels = measured.join(roots, measured.th == roots.node, "left").select("th", "n", F.coalesce("root", "th").alias("component"))
    given = docs.select(F.col(key).alias("k"), text_key(F.col(text)).alias("th"), F.col(text).isNotNull().alias("has_text"))
    known = given.where("has_text").join(labels, "th")
    least = known.where("n > 0").groupBy("component").agg(F.min("k").alias("least"))
    full = known.where("n > 0").join(least, "component").select("k", "n", "least")
    empty = known.where("n = 0").select("k", "n", F.col("k").alias("least"))
    blank = given.where("not has_text").select("k", F.lit(0).cast("long").alias("n"), F.col("k").alias("least"))
    return full.unionAll(empty).unionAll(blank).select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key and, of several texts
    under that key, the smallest text key. Rows with a null key come after all others. Of rows with
    the same key and text the first by a hash of all columns stays. Rows whose text has no word
    all stay."""
    columns = docs.columns
    measured, roots = linked_texts(docs, text)
    labels = measured.where("n > 0").join(roots, measured.th == roots.node, "left").select("th", F.coalesce("root", "th").alias("component"))
    has_words = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    given = docs.where(has_words).select(F.col(key).alias("k"), text_key(F.col(text)).alias("th"))
    first = F.min(F.struct(F.col("k").isNull().alias("last"), "k", "th")).alias("first")
    chosen = _keep(given.join(labels, "th").groupBy("component").agg(first), "chosen")
    free = "_" + max(columns, key=len)  # a name that no column has
    chosen = chosen.select(F.col("first.k").alias(f"{free}k"), F.col("first.th").alias(f"{free}th"))
    named = docs.where(has_words).withColumn(free, text_key(F.col(text)))
    kept = named.join(chosen, (F.col(free) == F.col(f"{free}th")) & F.col(key).eqNullSafe(F.col(f"{free}k")), "left_semi")
    once = kept.withColumn(f"{free}n", F.row_number().over(Window.partitionBy(key, free).orderBy(F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])))).where(F.col(f"{free}n") == 1)
    return once.select(*columns).unionAll(docs.where(~has_words).select(*columns))
