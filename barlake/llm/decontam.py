"""Benchmark decontamination by greedy string tiling.

Documents and test items that share a seed (a run of MIN_TILE words) are joined.
For each pair the longest match of unmarked words is marked as a tile, again and
again, until no match of MIN_TILE words is left. Matches are found by
Karp-Rabin: equal rolling hashes on one diagonal run on to a maximal match. The
tiles may lie in any order, so a reordered passage is caught as well. A document
is contaminated by an item if tiles cover enough of the item's words.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm import kernels
from barlake.llm.common import looked_up, read_table, small_batches, stored, typed

#: Words of a tile at least, and the share of an item's words that tiles must cover.
MIN_TILE, MIN_COVER = 5, 0.5
#: A benchmark of at most so many words is broadcast; a larger one is shuffled.
BROADCAST_WORDS = 2_000_000

OUT_SCHEMA = ("doc_id bigint, item_id bigint, version bigint, n_item_words bigint, n_covered bigint, "
              "n_tiles bigint, coverage double")


def hashed(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets of the rows) of parts of a column."""
    for row, _, data, offsets in kernels.slices(texts):
        starts, ends, first = kernels.word_bounds(data, offsets, kernels.NON_WORD)
        yield row, kernels.word_hashes(data, starts, ends), first


def rolling(words: np.ndarray, first: np.ndarray, k: int = MIN_TILE):
    """Hash, row and place of each run of k words; rows of fewer words have none."""
    hashes, rows, at = kernels.shingle_hashes(words, first, k)
    whole = np.diff(first)[rows] >= k
    return hashes[whole], rows[whole], (at - first[:-1][rows])[whole]


def matches(doc: np.ndarray, item: np.ndarray, k: int = MIN_TILE) -> np.ndarray:
    """Maximal matches as rows (words, place in the item, place in the document).

    The item's places are taken in turn. A hit at a document place whose left
    neighbour was hit by the place before runs that match on, so only the open
    matches are held, not all pairs of equal hashes."""
    a, _, at_a = rolling(doc, np.array([0, len(doc)]), k)
    b, _, at_b = rolling(item, np.array([0, len(item)]), k)
    out: list[np.ndarray] = []
    order = np.argsort(a, kind="stable")
    ranked = a[order]
    low, high = np.searchsorted(ranked, b, "left"), np.searchsorted(ranked, b, "right")
    hits, sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def close(j, ended, lengths):
        if len(ended):
            out.append(np.stack([lengths + k - 1, j - lengths, ended + 1 - lengths], axis=1).astype(np.int32))

    for j in range(len(b)):
        now = at_a[order[low[j]:high[j]]].astype(np.int64)  # rising, as the sort is stable
        at = np.searchsorted(hits, now - 1)
        on = at < len(hits)
        on[on] = hits[at[on]] == now[on] - 1
        grown = np.ones(len(now), np.int64)
        grown[on] += sizes[at[on]]
        over = np.ones(len(hits), bool)
        over[at[on]] = False
        close(j, hits[over], sizes[over])
        hits, sizes = now, grown
    close(len(b), hits, sizes)
    return np.concatenate(out) if out else np.empty((0, 3), np.int32)


def tiling(doc: np.ndarray, item: np.ndarray, k: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (words, place in the item, place in the document). The longest
    match goes first; between equals, the earlier in the item, then in the document.
    It ends where no stretch of k unmarked words is left in the item."""
    found = matches(doc, item, k)
    found = found[np.lexsort((found[:, 2], found[:, 1], -found[:, 0]))]
    cut: list[tuple[int, int, int]] = []  # what marked words left of matches, as a heap
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    out, at = [], 0

    def open_stretches(taken):
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        return [(s, e) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if e - s >= k]

    while at < len(found) or cut:
        whole = (-int(found[at, 0]), int(found[at, 1]), int(found[at, 2])) if at < len(found) else None
        if whole is None or cut and cut[0] < whole:
            size, j, i = heapq.heappop(cut)
        else:
            size, j, i = whole
            at += 1
        size = -size
        taken = in_item[j:j + size] | in_doc[i:i + size]
        if not taken.any():
            in_item[j:j + size] = in_doc[i:i + size] = True
            out.append((size, j, i))
            if not open_stretches(in_item):
                break
            continue
        for s, e in open_stretches(taken):
            heapq.heappush(cut, (s - e, j + s, i + s))
    return out


def seeds(df: DataFrame, key: list[str], wanted=None) -> DataFrame:
    """Distinct rolling hashes of each row's text with their numbers of places; only
    those in the sorted array ``wanted`` if given."""
    schema = ", ".join(f"{c} bigint" for c in key) + ", seed bigint, places bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value if wanted is not None else None
        for batch in batches:
            for row, words, first in hashed(batch.column("text")):
                found, rows, _ = rolling(words, first)
                found = found.view(np.int64)
                if known is not None:
                    at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                    held = known[at] == found if len(known) else np.zeros(len(found), bool)
                    found, rows = found[held], rows[held]
                if len(found):
                    order = np.lexsort((found, rows))
                    found, rows = found[order], rows[order]
                    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(rows) != 0) | (np.diff(found) != 0)]))
                    take = pa.array(rows[fresh] + row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(take) for c in key]
                        + [pa.array(found[fresh]), pa.array(np.diff(np.append(fresh, len(found))), pa.int64())],
                        names=[*key, "seed", "places"])

    return df.select(*key, "text").mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each pair of a document (doc_id, text) and an item (item_id,
    text) whose words its tiles cover to at least MIN_COVER.

    Texts that are null or have fewer than MIN_TILE words hold no tile and give
    no row. ``version`` (a hash of the text) tells documents of one id apart;
    null ids stay null; repeated documents and repeated items each give their
    rows; extra columns are ignored; empty tables give an empty result. Texts are
    joined only for pairs that share seed places enough for MIN_COVER.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = typed(docs, doc_id="bigint", text="string").withColumn("version", F.xxhash64("text"))
    items = typed(benchmark, item_id="bigint", text="string").withColumn("item_version", F.xxhash64("text"))
    item_key = ["item_id", "item_version"]
    item_seeds = stored(seeds(items.dropDuplicates(item_key), item_key), "item-seeds")
    # covering words takes a tile for each MIN_TILE of them at least, and each tile holds a seed
    places = F.sum("places").over(Window.partitionBy(*item_key))
    item_seeds = item_seeds.withColumn("needed", F.ceil(F.ceil((places + (MIN_TILE - 1)) * MIN_COVER) / MIN_TILE))
    small = item_seeds.count() <= BROADCAST_WORDS
    hint = F.broadcast if small else (lambda df: df)
    key = ["doc_id", "version"]
    if small:
        known = item_seeds.select("seed").distinct().toPandas()["seed"].to_numpy(np.int64)
        shared = seeds(docs, key, spark.sparkContext.broadcast(np.sort(known))).drop("places").join(hint(item_seeds), "seed")
    else:
        doc_seeds = stored(seeds(docs, key).drop("places"), "doc-seeds")
        held = doc_seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("held"))
        shared = looked_up(doc_seeds, stored(item_seeds.join(held, "seed"), "met-seeds"), "seed", "held", "inner")
    pairs = (shared.groupBy(*key, *item_key, "needed").agg(F.sum("places").alias("met")).where(F.col("met") >= F.col("needed"))
             .select(*key, *item_key).toDF("pair_doc", "pair_version", "pair_item", "pair_item_version"))
    items = items.select("item_id", "item_version", F.col("text").alias("item_text"))
    rows = (docs.join(pairs, F.col("doc_id").eqNullSafe(F.col("pair_doc"))
                      & (F.col("version") == F.col("pair_version")))
            .join(hint(items), F.col("item_id").eqNullSafe(F.col("pair_item"))
                  & (F.col("item_version") == F.col("pair_item_version")))
            .select("doc_id", "version", "item_id", "text", "item_text"))

    def words_of(column: pa.Array) -> list[np.ndarray]:
        out = []
        for _, words, first in hashed(column):
            out += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_item, n_covered, n_tiles = [], [], []
            for doc, item in zip(words_of(batch.column("text")), words_of(batch.column("item_text")), strict=True):
                found = tiling(doc, item)
                n_item.append(len(item))
                n_covered.append(sum(size for size, _, _ in found))
                n_tiles.append(len(found))
            size, covered = np.array(n_item, np.int64), np.array(n_covered, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "item_id", "version")]
                + [pa.array(size), pa.array(covered), pa.array(n_tiles, pa.int64()),
                   pa.array(covered / np.maximum(size, 1))],
                names=[x.split()[0] for x in OUT_SCHEMA.split(", ")])

    return rows.mapInArrow(run, OUT_SCHEMA).where(F.col("coverage") >= MIN_COVER)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("version")
