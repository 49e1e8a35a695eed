"""Vector code compression by Lloyd rounds over partition-local cover trees.

Every task cuts its vectors into blocks and builds a cover tree over each part of a
block: a node covers its points within its radius, its children cover them within
half of it and lie further apart than that. Points stand in tree order, so a
subtree is a stretch of rows whose counts and sums come from cumulative sums.

A round walks each tree from the root. A node whose second-nearest entry is
further away than the nearest one by more than twice its radius gives its whole
subtree to the nearest (triangle inequality); only ambiguous nodes descend, and
the points of ambiguous leaves are compared exactly. All is integer arithmetic,
so results don't depend on how rows lie in partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import looked_up, read_table, stored, typed

# Fixed values of the contract.
ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Vectors of a block; points of a node that isn't cut further.
BLOCK_ROWS, LEAF_POINTS = 1024, 8

TREE = [("points", pa.binary()), ("weight", pa.binary()), ("spot", pa.binary()), ("nodes", pa.binary()), ("radius", pa.binary())]
BLOCK_SCHEMA = ("vec_ids array<bigint>, labels array<bigint>, trees array<struct<" +
                ", ".join(f"{n}: binary" for n, _ in TREE) + ">>")
OUT_SCHEMA = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: in floats where no value can pass
    2^53, else in 64-bit integers (``integers`` has bounded the components)."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(others).max(initial=0)))
    kind = np.float64 if 4 * points.shape[1] * top * top < 2 ** 53 else np.int64
    p, o = points.astype(kind), others.astype(kind)
    return (p * p).sum(1)[:, None] + (o * o).sum(1)[None, :] - 2 * (p @ o.T)


def stretches(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All places of the stretches lo..hi, one after the other."""
    sizes = hi - lo
    return np.repeat(lo - (sizes.cumsum() - sizes), sizes) + np.arange(sizes.sum())


def integers(vectors: list[list[float]], size: int | None = None) -> np.ndarray:
    """floor(1024 x) of every component as rows of 64-bit integers."""
    lengths = {len(v) for v in vectors} | ({size} if size else set())
    if len(lengths) > 1 or any(n % PARTS for n in lengths):
        raise ValueError(f"vectors need one length that is a multiple of {PARTS}, not {sorted(lengths)}")
    scaled = np.floor(np.array(vectors, np.float64) * SCALE)
    if scaled.size and 4 * scaled.shape[1] * float(np.abs(scaled).max()) ** 2 >= 2.0 ** 62:
        raise OverflowError("components are too large for errors of 64 bits")
    return scaled.astype(np.int64)


class CoverTree:
    """Distinct points in tree order with their weights; nodes as stretches of them:
    columns of ``nodes`` are start, stop, first child and number of children."""

    def __init__(self, points, weight, nodes, radius):
        self.points, self.weight, self.nodes, self.radius = points, weight, nodes, radius

    @classmethod
    def build(cls, rows: np.ndarray) -> tuple["CoverTree", np.ndarray]:
        """The tree of the rows and each row's place in its order."""
        points, back, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        apart = squared(points, points)
        order = np.arange(len(points))
        nodes, radius, k = [[0, len(points), 0, 0]], [], 0
        while k < len(nodes):
            lo, hi = nodes[k][:2]
            rest = order[lo:hi]
            reach = apart[rest[0], rest].max()
            radius.append(np.sqrt(float(reach)))
            if hi - lo > LEAF_POINTS:
                nodes[k][2], at, cut = len(nodes), lo, []
                while len(rest):
                    near = 4 * apart[rest[0], rest] <= reach
                    cut.append(rest[near])
                    nodes.append([at, at + len(cut[-1]), 0, 0])
                    at, rest = at + len(cut[-1]), rest[~near]
                order[lo:hi] = np.concatenate(cut)
                nodes[k][3] = len(cut)
            k += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(points[order], weight[order], np.array(nodes, np.int64), np.array(radius)), place[back.ravel()]

    def pack(self, spot: np.ndarray) -> dict[str, bytes]:
        return {"points": self.points.astype("<i8").tobytes(), "weight": self.weight.astype("<i4").tobytes(),
                "spot": spot.astype("<i4").tobytes(), "nodes": self.nodes.astype("<i4").tobytes(),
                "radius": self.radius.astype("<f8").tobytes()}

    @classmethod
    def unpack(cls, tree: dict[str, bytes], width: int) -> tuple["CoverTree", np.ndarray]:
        def ints(name, kind):
            return np.frombuffer(tree[name], kind).astype(np.int64)
        return (cls(ints("points", "<i8").reshape(-1, width), ints("weight", "<i4"), ints("nodes", "<i4").reshape(-1, 4),
                    np.frombuffer(tree["radius"], "<f8")), ints("spot", "<i4"))

    def owners(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stretches (starts, stops) with the index of their nearest entry."""
        front = np.zeros(1, np.int64)
        while len(front):
            lo, hi, first, children = self.nodes[front].T
            apart = squared(self.points[lo], book)
            best = apart.argmin(1)  # the lowest index of equal ones
            rows = np.arange(len(front))
            near = np.sqrt(apart[rows, best].astype(np.float64))
            others = apart.astype(np.float64)
            others[rows, best] = np.inf
            far = np.sqrt(others.min(1))
            # a margin above the roots' rounding: too small a gap only descends
            settled = (far * (1 - 1e-9) > near + 2 * self.radius[front]) | (self.radius[front] == 0)
            yield lo[settled], hi[settled], best[settled]
            leaf = ~settled & (children == 0)
            if leaf.any():
                spots = stretches(lo[leaf], hi[leaf])
                yield spots, spots + 1, squared(self.points[spots], book).argmin(1)
            inner = ~settled & (children > 0)
            front = stretches(first[inner], first[inner] + children[inner])

    def sums(self, book: np.ndarray) -> np.ndarray:
        """Count and component sums of the points of each entry."""
        counted = np.concatenate([self.weight[:, None], self.points * self.weight[:, None]], axis=1)
        running = np.concatenate([np.zeros((1, counted.shape[1]), np.int64), counted.cumsum(0)])
        out = np.zeros((len(book), counted.shape[1]), np.int64)
        for lo, hi, best in self.owners(book):
            np.add.at(out, best, running[hi] - running[lo])
        return out

    def nearest(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each point in tree order."""
        owner = np.empty(len(self.points), np.int64)
        for lo, hi, best in self.owners(book):
            owner[stretches(lo, hi)] = np.repeat(best, hi - lo)
        return owner, ((self.points - book[owner]) ** 2).sum(1)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """Rows whose vector has components, all of them finite; other columns than
    vec_id, embedding and label are left behind."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return typed(vectors, vec_id="bigint", embedding="array<double>", label="bigint").where(
        (F.size("embedding") > 0) & ~bad)


def first_books(kept: DataFrame) -> list[np.ndarray] | None:
    """The parts of the ENTRIES smallest vec_ids (nulls last; of equal ids the
    smaller vector first)."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).collect()
    return np.split(integers([r["embedding"] for r in rows]), PARTS, axis=1) if rows else None


def blocks(kept: DataFrame, size: int) -> DataFrame:
    """Stored blocks of vectors, each with a cover tree for every part."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(ids, labels, vectors):
            trees = [tree.pack(spot) for tree, spot in map(CoverTree.build, np.split(integers(vectors, size), PARTS, axis=1))]
            return pa.RecordBatch.from_arrays([
                pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())),
                pa.array([trees], pa.list_(pa.struct(TREE)))], names=["vec_ids", "labels", "trees"])
        held: list[tuple] = []
        for batch in batches:
            held.extend(zip(*[batch.column(c).to_pylist() for c in ("vec_id", "label", "embedding")]))
            while len(held) >= BLOCK_ROWS:
                yield block(*zip(*held[:BLOCK_ROWS]))
                del held[:BLOCK_ROWS]
        if held:
            yield block(*zip(*held))

    return stored(kept.mapInArrow(run, BLOCK_SCHEMA), "blocks")


def next_books(table: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: entries become the floored means of their parts. Tasks send one
    sum for each component of each entry, whatever their rows."""
    spark, width = table.sparkSession, books[0].shape[1]
    shared = spark.sparkContext.broadcast(books)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, len(books[0]), width + 1), np.int64)
        for batch in batches:
            for trees in batch.column("trees").to_pylist():
                for part, (tree, book) in enumerate(zip(trees, shared.value)):
                    total[part] += CoverTree.unpack(tree, width)[0].sums(book)
        flat = total.ravel()
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(flat[slots], pa.int64())], names=["slot", "value"])

    summed = table.mapInArrow(run, "slot bigint, value bigint").groupBy("slot").agg(F.sum("value").alias("value"))
    total = np.zeros((PARTS, len(books[0]), width + 1), np.int64)
    for row in summed.collect():  # at most one row a component
        total.ravel()[row["slot"]] = row["value"]
    shared.unpersist()
    count, sums = total[:, :, :1], total[:, :, 1:]
    return [np.where(count[p] > 0, sums[p] // np.maximum(count[p], 1), books[p]) for p in range(PARTS)]


def encoded(table: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of every vector."""
    width, shared = books[0].shape[1], table.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, trees in zip(*[batch.column(c).to_pylist() for c in ("vec_ids", "labels", "trees")]):
                owners, error = np.empty((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
                for part, (packed, book) in enumerate(zip(trees, shared.value)):
                    tree, spot = CoverTree.unpack(packed, width)
                    owner, apart = tree.nearest(book)
                    owners[:, part] = owner[spot]
                    error += apart[spot]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array([o.tobytes().hex() for o in owners], pa.string()),
                     pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return table.mapInArrow(run, "vec_id bigint, label bigint, code string, error bigint")


def books_text(books: list[np.ndarray]) -> str:
    return ",".join(str(x) for book in books for x in book.ravel().tolist())


def compressed(vectors: DataFrame) -> DataFrame:
    """One row per kept row of ``vectors`` (vec_id, embedding, label): its code, its
    squared error, its label's error and the codebooks' hash.

    Rows whose vector is null, empty, or holds a null or a number that isn't finite
    are dropped. With fewer than ENTRIES vectors the codebooks are that short.
    Null vec_ids come last in the start order and stay null, null labels count
    as one label, repeated rows each count and give a row, extra columns are
    ignored, an empty table gives an empty result. Vectors of different lengths, or
    of no multiple of PARTS, and components whose errors pass 64 bits fail with a
    message.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors)
    books = first_books(kept)
    if books is None:
        return spark.createDataFrame([], OUT_SCHEMA)
    table = blocks(kept, PARTS * books[0].shape[1])
    for _ in range(ROUNDS):
        books = next_books(table, books)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    codes = stored(encoded(table, books).withColumn("of", F.coalesce(F.col("label").cast("string"), F.lit(""))), "codes")
    sums = stored(codes.groupBy("of").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")), "labels")
    return looked_up(codes, sums, "of", "rows").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(read_table(spark, sf_dir, "embeddings"))


def _round_sql(k: int) -> str:
    return f"""
near{k} AS MATERIALIZED (
  SELECT rid, part, min(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {ENTRIES} + entry) AS best
  FROM parts AS p JOIN book{k} AS b USING (part) GROUP BY rid, part),
mean{k} AS MATERIALIZED (
  SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY place) AS v FROM (
    SELECT part, best % {ENTRIES} AS entry, place, sum(x)::BIGINT AS s, count(*) AS c
    FROM near{k} JOIN (SELECT rid, part, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM parts) USING (rid, part)
    GROUP BY ALL) GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{k} AS b LEFT JOIN mean{k} AS m USING (part, entry)),"""


SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS v
  FROM kept, range({PARTS}) AS r(part)),
book0 AS MATERIALIZED (SELECT part, rid AS entry, v FROM parts WHERE rid < {ENTRIES}),
{"".join(map(_round_sql, range(ROUNDS)))}
last AS MATERIALIZED (
  SELECT rid, part, min(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {ENTRIES} + entry) AS best
  FROM parts AS p JOIN book{ROUNDS} AS b USING (part) GROUP BY rid, part),
coded AS (SELECT rid, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code, sum(best // {ENTRIES})::BIGINT AS error
          FROM last GROUP BY rid),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest
"""
