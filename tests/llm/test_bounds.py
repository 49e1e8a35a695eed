"""Bounded work: tiling of repeated words, lines of long documents, samples, seeds by shuffle."""
import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from barlake.llm import common, decontam, line_dedup
from conftest import SF_SMALL
from test_queries import slow_tiling


def words(text):
    return np.array([hash(w) & (2 ** 63 - 1) for w in text], np.uint64)


def test_matches_of_repeated_words_hold_few_pairs():
    doc, item = words("a" * 40_000), words("a" * 400)
    tracemalloc.start()
    got = decontam.tiling(doc, item)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(400, 0, 0)] and peak < 200e6
    mixed = words(("aaaaab" * 5_000))
    tracemalloc.start()
    tiles = decontam.tiling(mixed, item)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(s for s, _, _ in tiles) == 400 and peak < 400e6


def test_tiling_equals_brute_force_on_small_alphabets():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (list(rng.choice(list("ab"), rng.integers(0, 40))) for _ in range(2))
        assert decontam.tiling(words(a), words(b)) == slow_tiling(a, b, decontam.MIN_TILE)


def test_seeds_by_shuffle_find_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = sorted(map(tuple, decontam.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_WORDS", 0)
    monkeypatch.setattr(common, "HOT_KEYS", 5)
    assert sorted(map(tuple, decontam.contaminated(docs, items).collect())) == want and want


def test_lines_of_long_documents_take_time_in_proportion(spark):
    def run(n):
        rows = [(i, "\n".join(["Read our terms."] + ([f"line {k} of {i}" for k in range(n)] if i == 3 else [f"own {i}"])), f"s{i}")
                for i in range(6)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        begin = time.perf_counter()
        got = {r.doc_id: r for r in line_dedup.deduplicated(df).collect()}
        assert got[3].n_lines == n + 1 and got[3].n_removed == 1 and len(got[3].text.split("\n")) == n
        return time.perf_counter() - begin
    run(100)
    short = run(16_000)
    assert run(64_000) < 8 * short + 5


def test_samples_are_the_smallest_hashes_of_each_group(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, "rare").otherwise("often").alias("g"), F.xxhash64("id").alias("h"))
    df = df.unionByName(df.where("g = 'often'").limit(1).select("g", "h").crossJoin(spark.range(3_000)).drop("id"))  # copies
    got = common.smallest_hashes(df, "g", "h", 300).collect()
    for group in ("rare", "often"):
        every = sorted({r.h for r in df.where(F.col("g") == group).collect()})
        assert sorted(r.h for r in got if r.g == group) == every[:300]
