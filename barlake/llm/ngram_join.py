"""Similarity join of documents by word shingles, and its components.

Documents with equal shingle sets form a class (a 128-bit sum of the set), and
classes are joined. The document-by-shingle incidence matrix is multiplied by
its transpose in blocks of columns. Only columns in a class's prefix are kept:
with all shingles in one order, two sets that link share one of their first
``n / 4 + 1``. The order puts frequent shingles last, so hot columns rarely
stand in a prefix.

Components need not see every link. In a long column each class is first paired
with few pivots only: of the classes of about its size, the one with the most
frequent shingles, which is the one that most others are copies of. After these
pairs are verified and components known, pairs of long columns are formed across
components, which leaves out no link that could join two components. Columns
are cut into square blocks of classes for that.

Sizes, and counts of shingles by the first bits of their hash, bound the overlap
of a pair from above; pairs below the bound go before any set is read. What is
left is verified by exact counting on both whole sets.

``class_links`` gives all links: components are exact, so each link lies within
one, and the product of a component's whole incidence matrix is formed in square
blocks of classes, its overlaps summed over blocks of columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import kernels
from barlake.llm.common import read_table, small_batches, stored, typed
from barlake.llm.components import roots

SHINGLE_WORDS = 5
#: Two sets link when 4 * shared >= 3 * joint, a Jaccard similarity of 0.75.
SHARED, JOINT = 4, 3
#: Classes of a column up to which all its pairs are formed at once.
FULL_COLUMN = 6
#: Classes on a side of the blocks that long columns are cut into.
BLOCK = 1024
#: Shingles on a side of the blocks in which all links are counted, and their columns at once.
BLOCK_SHINGLES, COLUMNS = 1 << 21, 4096
#: Counters of a task's summary of frequent shingles, the most that are
#: broadcast, and the documents that make a shingle frequent. They only decide
#: the order of shingles and the pivots, never a result.
SUMMARY, MOST_FREQUENT, FREQUENT_DOCUMENTS = 1 << 17, 1 << 21, 12
#: Documents of a frequent shingle for each part that its column is salted into.
SALT_DOCUMENTS = 4096
#: Classes to verify whose ids are broadcast at most; more are joined by shuffle.
BROADCAST_CLASSES = 200_000
#: Counts in a coarse sketch. A set with more than PER_COUNT shingles for each has
#: a fine one besides, with twice as many counts as often as it takes.
COUNTS, PER_COUNT = 256, 8

U = np.uint64


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct hashes in ascending order row by row, offsets)."""
    for row, end, data, offsets in kernels.slices(texts):
        starts, ends, first = kernels.word_bounds(data, offsets, kernels.SPACES)
        hashes, rows, _ = kernels.shingle_hashes(kernels.word_hashes(data, starts, ends), first, SHINGLE_WORDS)
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        if len(hashes):
            fresh = np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])])
            hashes, rows = hashes[fresh], rows[fresh]
        yield row, hashes, np.searchsorted(rows, np.arange(end - row + 1))


def class_ids(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit sum of each row's set, as two signed halves."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (11, 12):
            total = np.concatenate([np.zeros(1, U), np.cumsum(kernels.mix(hashes, salt))])
            out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def _counted(hashes: np.ndarray, size: int) -> np.ndarray:
    return np.bincount((hashes >> U(64 - (size.bit_length() - 1))).astype(np.int64), minlength=size)


def _packed(counts: np.ndarray) -> bytes:
    """Counts in units that let the largest fit a byte, rounded up; the unit goes first."""
    unit = max(-(-int(counts.max()) // 255), 1)
    return unit.to_bytes(4, "little") + (-(-counts // unit)).astype(np.uint8).tobytes()


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[bytes | None]]:
    """Coarse sketch of each row's set, and the fine one of a large set."""
    n = np.diff(offsets)
    rows = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(rows * COUNTS + (hashes >> U(56)).astype(np.int64), minlength=COUNTS * len(n)).reshape(-1, COUNTS)
    fine: list[bytes | None] = [None] * len(n)
    for i in np.flatnonzero(n > COUNTS * PER_COUNT):
        size = COUNTS
        while n[i] > size * PER_COUNT:
            size *= 2
        fine[i] = _packed(_counted(hashes[offsets[i]:offsets[i + 1]], size))
    return [_packed(c) for c in counts], fine


def unpacked(sketch: bytes) -> np.ndarray:
    """Upper bounds of the counts."""
    return np.frombuffer(sketch, np.uint8, offset=4).astype(np.int64) * int.from_bytes(sketch[:4], "little")


def most_shared(sketch: bytes, other: bytes) -> int:
    """Upper bound of the overlap of two sets; the finer sketch is folded to the other's size."""
    x, y = unpacked(sketch), unpacked(other)
    if len(x) < len(y):
        x, y = y, x
    return int(np.minimum(x.reshape(len(y), -1).sum(1), y).sum())


def bounded(overlap: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether an overlap of at most ``overlap`` may link sets of these sizes."""
    return (SHARED + JOINT) * overlap >= JOINT * (n + m)


class _Summary:
    """Mergeable counts of frequent hashes (Misra-Gries)."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, U), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, hashes: np.ndarray) -> None:
        self.waiting.append(hashes)
        self.held += len(hashes)
        if self.held >= 4 * SUMMARY:
            self.merge()

    def merge(self) -> None:
        keys, counts = np.unique(np.concatenate(self.waiting or [np.zeros(0, U)]), return_counts=True)
        keys = np.concatenate([self.keys, keys])
        counts = np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > SUMMARY:
            counts = counts - np.partition(counts, len(counts) - SUMMARY - 1)[len(counts) - SUMMARY - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts, self.waiting, self.held = keys, counts, [], 0


SETS_SCHEMA = ("doc_id bigint, version bigint, n bigint, a bigint, b bigint, coarse binary, fine binary, "
               "frequent bigint, times bigint")


def document_sets(docs: DataFrame) -> DataFrame:
    """A row per document (size, class and sketch of its set) and, with a null n,
    rows of the tasks' summaries of frequent shingles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = _Summary()
        names = [x.split()[0] for x in SETS_SCHEMA.split(", ")]
        for batch in batches:
            for row, hashes, offsets in shingle_sets(batch.column("text")):
                n = len(offsets) - 1
                a, b = class_ids(hashes, offsets)
                summary.add(hashes)
                coarse, fine = sketches(hashes, offsets)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, n), batch.column("version").slice(row, n),
                     pa.array(np.diff(offsets).astype(np.int64)), pa.array(a), pa.array(b),
                     pa.array(coarse, pa.binary()), pa.array(fine, pa.binary()), none, none], names=names)
        summary.merge()
        often = summary.counts > 1
        for at in range(0, int(often.sum()), 1 << 16):
            keys = summary.keys[often][at:at + (1 << 16)].view(np.int64)
            none = pa.nulls(len(keys), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none] * 5 + [pa.nulls(len(keys), pa.binary()), pa.nulls(len(keys), pa.binary()), pa.array(keys),
                              pa.array(summary.counts[often][at:at + (1 << 16)])], names=names)

    return docs.select("doc_id", "version", "text").mapInArrow(run, SETS_SCHEMA)


def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that many documents hold, in ascending order, and about how many
    hold each; MOST_FREQUENT at most."""
    counted = (sets.where("frequent is not null").groupBy("frequent").agg(F.sum("times").alias("times"))
               .where(F.col("times") >= FREQUENT_DOCUMENTS).orderBy(F.desc("times"), "frequent")
               .limit(MOST_FREQUENT).toPandas())
    hashes = counted["frequent"].to_numpy(np.int64).view(U)
    order = np.argsort(hashes)
    return hashes[order], counted["times"].to_numpy(np.int64)[order]


COLUMN_SCHEMA = "h bigint, salt int, cut boolean, a bigint, n int, often int"


def prefix_columns(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The incidence matrix's entries in prefixes: a row for each class and
    shingle of its prefix, with the number of the class's frequent shingles. A
    task emits a class once; a very frequent shingle's column is salted (``cut``).
    Half of the class's id does here: classes that share it are told apart when
    pairs are verified, and would have to share a shingle as well to meet."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (often, times), seen = shared.value, set()
        for batch in batches:
            for _, hashes, offsets in shingle_sets(batch.column("text")):
                n = np.diff(offsets)
                a, b = class_ids(hashes, offsets)
                fresh = np.zeros(len(n), bool)
                for i in np.flatnonzero(n):
                    key = (int(a[i]), int(b[i]))
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                rows = np.repeat(np.arange(len(n)), n)
                take = fresh[rows]
                rows, hashes = rows[take], hashes[take]
                if not len(rows):
                    continue
                at = np.minimum(np.searchsorted(often, hashes), max(len(often) - 1, 0))
                hot = often[at] == hashes if len(often) else np.zeros(len(hashes), bool)
                n_hot = np.bincount(rows, weights=hot, minlength=len(n)).astype(np.int32)
                salts = np.where(hot, 1 + times[at] // SALT_DOCUMENTS, 1) if len(often) else np.ones(len(hashes), int)
                order = np.lexsort((hashes, hot, rows))
                rows, hashes, salts = rows[order], hashes[order], salts[order]
                size = np.where(fresh, n, 0)
                place = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
                keep = place <= n[rows] // 4
                rows, hashes, salts = rows[keep], hashes[keep], salts[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array((a[rows] % salts).astype(np.int32)), pa.array(salts > 1),
                     pa.array(a[rows]), pa.array(n[rows].astype(np.int32)), pa.array(n_hot[rows])],
                    names=[x.split()[0] for x in COLUMN_SCHEMA.split(", ")])

    return docs.select("text").mapInArrow(run, COLUMN_SCHEMA)


PAIR = ["a", "b", "a2", "b2"]
PRODUCT_SCHEMA = "h bigint, a bigint, n int, a2 bigint"
_PRODUCT = [x.split()[0] for x in PRODUCT_SCHEMA.split(", ")]


def _sizes_allow(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SHARED * np.minimum(n, m) >= JOINT * np.maximum(n, m)


def _gathered(batches: Iterable[pa.RecordBatch], names: list[str]) -> list[np.ndarray] | None:
    """The columns of a task's part of a shuffle, which holds a bounded share of all entries."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return None
    return [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in table]) for c in names]


def _begins(*keys: np.ndarray) -> np.ndarray:
    """Where a group of equal keys begins, in sorted arrays."""
    fresh = np.zeros(len(keys[0]), bool)
    fresh[:1] = True
    for k in keys:
        fresh[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(fresh)


def _pair_batches(a, left, right) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of entries, the smaller class first."""
    low, high = np.minimum(a[left], a[right]), np.maximum(a[left], a[right])
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    fresh = _begins(low, high)
    low, high = low[fresh], high[fresh]
    for at in range(0, len(low), 1 << 16):
        i, j = low[at:at + (1 << 16)], high[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(i), pa.int64()), pa.array(i), pa.nulls(len(i), pa.int32()), pa.array(j)], names=_PRODUCT)


def _within(size: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside each of the short groups that begin at ``begin``."""
    lefts, rights = [], []
    for s in np.unique(size):
        at = begin[size == s]
        i, j = np.triu_indices(int(s), 1)
        lefts.append((at[:, None] + i).ravel())
        rights.append((at[:, None] + j).ravel())
    none = np.zeros(0, np.int64)
    return np.concatenate(lefts or [none]), np.concatenate(rights or [none])


def block_product(columns: DataFrame) -> DataFrame:
    """Candidate pairs of classes and, with a column's hash in ``h``, the entries
    of columns whose pairs weren't all formed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _gathered(batches, ["h", "salt", "cut", "a", "n", "often"])
        if got is None:
            return
        # sets of which one is at most 4/3 of the other have bands that differ by one at most
        band = np.floor(np.log(got[4]) / np.log(SHARED / JOINT)).astype(np.int64)
        order = np.lexsort((got[3], -got[5], band, got[1], got[0]))
        h, salt, cut, a, n, _ = (x[order] for x in got)
        band = band[order]
        fresh = _begins(h, salt, a)
        h, salt, cut, a, n, band = (x[fresh] for x in (h, salt, cut, a, n, band))
        begin = _begins(h, salt)
        size = np.diff(np.append(begin, len(h)))
        few = (size > 1) & (size <= FULL_COLUMN)
        left, right = _within(size[few], begin[few])
        lefts, rights = [left], [right]
        long = np.repeat(size > FULL_COLUMN, size)
        column = np.repeat(np.arange(len(begin)), size)
        pivot = _begins(column, band)  # of a column's band, the class with the most frequent shingles
        spot = column[pivot] * 4096 + band[pivot]
        for step in (-1, 0, 1):
            want = column * 4096 + band + step
            at = np.minimum(np.searchsorted(spot, want), len(spot) - 1)
            hit = np.flatnonzero(long & (spot[at] == want) & (band + step >= 0))
            lefts.append(pivot[at[hit]])
            rights.append(hit)
        left, right = np.concatenate(lefts), np.concatenate(rights)
        allow = (left != right) & _sizes_allow(n[left], n[right])
        yield from _pair_batches(a, left[allow], right[allow])
        members = np.flatnonzero(long | cut)
        for at in range(0, len(members), 1 << 16):
            m = members[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(h[m]), pa.array(a[m]), pa.array(n[m]), pa.nulls(len(m), pa.int64())],
                                             names=_PRODUCT)

    return columns.repartition("h", "salt").mapInArrow(run, PRODUCT_SCHEMA)


def in_blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries of columns with classes of several components, dealt to blocks: an
    entry's part of the column meets each part once, as row or column ``side``."""
    mixed = (members.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("ra", "rb")).alias("low"),
                                      F.max(F.struct("ra", "rb")).alias("high"))
             .where("low <> high").select("h", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    return (members.join(mixed, "h").join(classes.select("a", "coarse"), "a").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("h", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                    (F.col("own") > F.col("other")).alias("side"), "a", "n", "ra", "rb", "coarse"))


def cross_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs of a block's classes that lie in different components and may link
    by their sizes and sketches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _gathered(batches, ["h", "low", "high", "side", "n", "ra", "rb", "a", "coarse"])
        if got is None:
            return
        order = np.lexsort((got[7], got[4], got[3], got[2], got[1], got[0]))
        h, low, high, side, n, ra, rb, a, coarse = (x[order] for x in got)
        n = n.astype(np.int64)
        begin = _begins(h, low, high)
        lefts, rights = [], []
        for start, stop in zip(begin, np.append(begin[1:], len(h)), strict=True):
            middle = start + int(np.searchsorted(side[start:stop], True)) if low[start] != high[start] else start
            counts = np.array([unpacked(c) for c in coarse[start:stop]]).astype(np.int32)
            for i in range(start, middle if low[start] != high[start] else stop):
                first = i + 1 if middle == start else middle
                # sizes ascend: only a stretch of them allows a link
                first += int(np.searchsorted(SHARED * n[first:stop], JOINT * n[i]))
                last = first + int(np.searchsorted(JOINT * n[first:stop], SHARED * n[i], "right"))
                j = np.arange(first, last)
                j = j[(ra[j] != ra[i]) | (rb[j] != rb[i])]
                if len(j):
                    most = np.minimum(counts[j - start], counts[i - start]).sum(1, dtype=np.int64)
                    j = j[bounded(most, n[j], n[i])]
                    lefts.append(np.full(len(j), i))
                    rights.append(j)
        none = [np.zeros(0, np.int64)]
        yield from _pair_batches(a, np.concatenate(lefts + none), np.concatenate(rights + none))

    return blocks.repartition("h", "low", "high").mapInArrow(run, PRODUCT_SCHEMA).select("a", "a2")


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, a2) that may link by the finest sketches of their classes, as
    pairs of whole ids."""
    one = classes.select("a", "b", "n", F.coalesce("fine", "coarse").alias("sketch"))
    rows = pairs.join(one, "a").join(one.toDF("a2", "b2", "n2", "sketch2"), "a2")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "n2"))
            most = [most_shared(x, y) for x, y in zip(batch.column("sketch").to_pylist(),
                                                      batch.column("sketch2").to_pylist(), strict=True)]
            yield batch.select(PAIR).filter(pa.array(bounded(np.array(most, np.int64), n, m), pa.bool_()))

    return rows.select(*PAIR, "n", "sketch", "n2", "sketch2").mapInArrow(run, ", ".join(f"{c} bigint" for c in PAIR))


def class_sets(docs: DataFrame) -> DataFrame:
    """(a, b, set) of documents, the set being its sorted hashes as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, offsets in shingle_sets(batch.column("text")):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").slice(row, n), batch.column("b").slice(row, n),
                     pa.array([hashes[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)],
                              pa.binary())], names=["a", "b", "set"])

    return docs.select("a", "b", "text").mapInArrow(run, "a bigint, b bigint, set binary")


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole sets link. Each class's set is made from one
    document of it."""
    wanted = pairs.select("a", "b").unionByName(pairs.select(F.col("a2").alias("a"), F.col("b2").alias("b"))).distinct()
    chosen = stored(wanted.join(classes, ["a", "b"]).select(
        "a", "b", F.col("least.doc_id").alias("its_id"), F.col("least.version").alias("its_version")), "chosen")
    if chosen.count() <= BROADCAST_CLASSES:
        chosen = F.broadcast(chosen)
    sets = class_sets(docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("its_id"))
                                & (F.col("version") == F.col("its_version"))))
    sets = stored(sets, "sets")
    other = sets.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("set").alias("set2"))
    if pairs.count() <= BROADCAST_CLASSES:  # four numbers a row
        pairs = F.broadcast(pairs)
    rows = other.join(pairs, ["a2", "b2"]).join(sets, ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set"), batch.column("set2"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                shared = int((large[at] == small).sum())
                keep.append(SHARED * shared >= JOINT * (len(x) + len(y) - shared))
            yield batch.select(PAIR).filter(pa.array(keep, pa.bool_()))

    # repeated rows of a document give its set twice
    return rows.select(*PAIR, "set", "set2").mapInArrow(run, ", ".join(f"{c} bigint" for c in PAIR)).distinct()


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.struct("a", "b").alias("u"), F.struct(F.col("a2").alias("a"), F.col("b2").alias("b")).alias("v"))


def _flat(found: DataFrame) -> DataFrame:
    return found.select(F.col("node.a").alias("a"), F.col("node.b").alias("b"),
                        F.col("root.a").alias("ra"), F.col("root.b").alias("rb"))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The typed documents, their sets' sizes and classes, and the classes with the
    root of their component."""
    small_batches(docs.sparkSession)
    docs = typed(docs, doc_id="bigint", text="string").withColumn("version", F.xxhash64("text"))
    sets = stored(document_sets(docs), "shingle-sets")
    frequent = frequent_shingles(sets)
    rows = sets.where("n is not null").drop("frequent", "times")
    classes = stored(rows.where("n > 0").groupBy("a", "b").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")).alias("least"),
        F.max("n").alias("n"), F.max("coarse").alias("coarse"), F.max("fine").alias("fine")), "classes")
    product = stored(block_product(prefix_columns(docs, frequent)), "product")
    pairs = stored(product.where("h is null").select("a", "a2").distinct(), "pairs")
    links = stored(linked(stored(plausible(pairs, classes), "plausible"), classes, docs), "links")
    found = _flat(roots(_edges(links)))
    # a class in no link is a component of its own
    members = (product.where("h is not null").select("h", "a", "n").distinct()
               .join(found.select("a", "ra", "rb"), "a", "left")
               .select("h", "a", "n", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", F.lit(0)).alias("rb")))
    cross = stored(cross_pairs(in_blocks(members, classes)).distinct().join(pairs, ["a", "a2"], "left_anti"), "cross")
    if not cross.isEmpty():
        later = stored(linked(stored(plausible(cross, classes), "plausible"), classes, docs), "links")
        found = _flat(roots(_edges(links.unionByName(later))))
    found = stored(classes.join(found, ["a", "b"], "left").select(
        "a", "b", "least", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")), "roots")
    return docs, rows, found


def components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, version (a hash of
    the text), n_shingles, component_id (smallest doc_id of the component), and
    ``first`` for the rows of the component's smallest (doc_id, version).

    A null or blank text has no shingles and is linked with nothing: it is its
    own component. Null doc_ids count as larger than others: a component of
    such alone has a null id. Repeated rows each give a row, extra columns are
    ignored, an empty table gives an empty result.
    """
    _, rows, found = _classes(docs)
    smallest = found.groupBy("ra", "rb").agg(F.min("least").alias("smallest"))
    named = found.join(smallest, ["ra", "rb"]).select("a", "b", "smallest")
    own = rows.where("n = 0").select("doc_id", "version", F.col("n").alias("n_shingles"),
                                     F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return rows.where("n > 0").drop("coarse", "fine").join(named, ["a", "b"]).select(
        "doc_id", "version", F.col("n").alias("n_shingles"), F.col("smallest.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("smallest.doc_id")) & (F.col("version") == F.col("smallest.version"))).alias("first"),
    ).unionByName(own)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of each left with each right set."""
    out = np.zeros((len(left), len(right)), np.int64)
    columns = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def entries(sets):
        hashes, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(columns, hashes), max(len(columns) - 1, 0))
        hit = columns[at] == hashes if len(columns) else np.zeros(len(hashes), bool)
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], rows[hit][order]

    sides = [(entries(x), len(x)) for x in (left, right)]
    for first in range(0, len(columns), COLUMNS):
        parts = []
        for (at, rows), n in sides:
            low, high = np.searchsorted(at, [first, first + COLUMNS])
            part = np.zeros((n, min(COLUMNS, len(columns) - first)), np.float32)
            part[rows[low:high], at[low:high] - first] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


LINK_SCHEMA = ", ".join(f"{c} bigint" for c in [*PAIR, "shared"])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(left ids, right ids, one block with itself, links, shared) of each block of a
    component's classes; ids are the arrays (a, b)."""
    got = _gathered(batches, ["ra", "rb", "low", "high", "side", "a", "b", "set"])
    if got is None:
        return
    order = np.lexsort([got[i] for i in (6, 5, 4, 3, 2, 1, 0)])
    ra, rb, low, high, side, a, b, held = (x[order] for x in got)
    begin = _begins(ra, rb, low, high)
    for start, stop in zip(begin, np.append(begin[1:], len(a)), strict=True):
        sets = [np.frombuffer(x, U) for x in held[start:stop]]
        n = np.array([len(x) for x in sets], np.int64)
        same = low[start] == high[start]
        middle = 0 if same else int(np.searchsorted(side[start:stop], True))
        left = slice(0, len(sets) if same else middle)
        if not sets[left] or not sets[middle:]:
            continue
        shared = overlaps(sets[left], sets[middle:])
        links = SHARED * shared >= JOINT * (n[left][:, None] + n[middle:] - shared)
        ids = a[start:stop], b[start:stop]
        yield [x[left] for x in ids], [x[middle:] for x in ids], same, links, shared


def _block_links(dealt: DataFrame) -> DataFrame:
    """The links of each block of a component's classes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (a, b), (a2, b2), same, links, shared in _blocks(batches):
            i, j = np.nonzero(np.triu(links, 1) if same else links)
            for at in range(0, len(i), 1 << 16):
                x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (a[x], b[x], a2[y], b2[y], shared[x, y])], names=[*PAIR, "shared"])

    return dealt.repartition("ra", "rb", "low", "high").mapInArrow(run, LINK_SCHEMA)


def _block_counts(dealt: DataFrame) -> DataFrame:
    """(a, b, links): how many links each class has in a block; a row a class and block,
    whatever its links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lefts, rights, same, links, _ in _blocks(batches):
            if same:
                links = links & ~np.eye(len(links), dtype=bool)
            sides = [(lefts, links.sum(1))] if same else [(lefts, links.sum(1)), (rights, links.sum(0))]
            for (a, b), n in sides:
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(b[some]), pa.array(n[some].astype(np.int64))],
                                                 names=["a", "b", "links"])

    return dealt.repartition("ra", "rb", "low", "high").mapInArrow(run, "a bigint, b bigint, links bigint")


def _dealt(docs: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """The sets of each component's classes, dealt to the blocks that compare them."""
    sizes = rows.where("n > 0").select("a", "b", "n").distinct()
    parts = (found.join(sizes, ["a", "b"]).groupBy("ra", "rb").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("n"))
             .where("many > 1").select("ra", "rb", F.greatest(F.ceil(F.col("many") / BLOCK), F.ceil(
                 F.col("n") / BLOCK_SHINGLES)).cast("int").alias("parts")))
    chosen = stored(found.join(parts, ["ra", "rb"]).select(
        "a", "b", "ra", "rb", "parts", F.col("least.doc_id").alias("its_id"),
        F.col("least.version").alias("its_version")), "chosen")
    # repeated rows of a document give its set twice; the document's row carries the class
    sets = class_sets(docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("its_id"))
                                & (F.col("version") == F.col("its_version"))).dropDuplicates(["a", "b"]))
    own = F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int")
    return (sets.join(chosen.drop("its_id", "its_version"), ["a", "b"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("ra", "rb", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     (F.col("own") > F.col("other")).alias("side"), "a", "b", "set"))


def class_links(docs: DataFrame) -> DataFrame:
    """All links: (a, b, a2, b2, shared), a row for each pair of classes whose sets
    link, with the shingles that they share. A class (a, b: the hash of a set) has one
    row for all its documents, so repeated rows, copies and ids (null or not) change
    nothing; null and blank texts have no class; extra columns are ignored; an empty
    table gives an empty result."""
    return _block_links(_dealt(*_classes(docs)))


def document_links(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles and n_links, the
    number of other classes (texts of another shingle set) that its class links with.
    Links are counted in their blocks, so n near copies give n rows a block and not
    n * n. Null and blank texts have no shingles and no links, null ids stay null,
    repeated rows each give a row, extra columns are ignored, an empty table gives
    an empty result."""
    docs, rows, found = _classes(docs)
    counted = _block_counts(_dealt(docs, rows, found)).groupBy("a", "b").agg(F.sum("links").alias("n_links"))
    some = rows.where("n > 0").select("doc_id", "n", "a", "b").join(counted, ["a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    return some.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                                       F.lit(0).cast("bigint").alias("n_links")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_links(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g FROM d),
classes AS (SELECT min(doc_id) AS id, list_sort(g) AS g FROM grams GROUP BY list_sort(g)),
cells AS (SELECT id, len(g) AS n, unnest(g) AS s FROM classes),
links AS (SELECT x.id AS u, y.id AS v FROM cells x JOIN cells y ON x.s = y.s AND x.id < y.id
          AND 4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n)
          GROUP BY x.id, y.id, x.n, y.n HAVING 4 * count(*) >= 3 * (x.n + y.n - count(*))),
reach AS (WITH RECURSIVE r(u, v) AS (
            SELECT id, id FROM classes UNION
            SELECT r.u, e.v FROM r JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) e ON r.v = e.u)
          SELECT v AS id, min(u) AS root FROM r GROUP BY v)
SELECT g.doc_id, len(g.g)::BIGINT AS n_shingles,
       CASE WHEN len(g.g) = 0 THEN g.doc_id ELSE reach.root END AS component_id
FROM grams g JOIN classes c ON list_sort(g.g) = c.g JOIN reach ON reach.id = c.id
"""

#: The same links, counted for each document.
LINKS_SQL = SQL[:SQL.index("reach AS (")].rstrip().removesuffix(",") + r"""
SELECT g.doc_id, len(g.g)::BIGINT AS n_shingles, coalesce(e.n, 0)::BIGINT AS n_links
FROM grams g JOIN classes c ON list_sort(g.g) = c.g
LEFT JOIN (SELECT id, count(*) AS n FROM (SELECT u AS id FROM links UNION ALL SELECT v FROM links) GROUP BY id) e ON e.id = c.id
"""
