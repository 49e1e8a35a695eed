"""All links of the n-gram join against brute force."""
import numpy as np

from barlake.llm import ngram_join
from test_edges import slow_components


def test_all_links_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    base, rows = list(rng.choice(words, 80)), []
    for i in range(60):  # near copies: one long column each, most of them link
        copy = list(base)
        for _ in range(int(rng.integers(0, 4))):
            copy[int(rng.integers(80))] = str(rng.choice(words))
        rows.append((i, " ".join(copy)))
    rows += [(100, rows[0][1].upper()), (101, " ".join(rng.choice(words, 50))), (102, None), (None, rows[1][1] + " end")]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in ((t or "").lower().split() for _, t in rows)]
    kinds = {frozenset(s) for s in sets if s}
    want = sorted((str(d), len(s), sum(4 * len(s & o) >= 3 * len(s | o) for o in kinds if o != s) if s else 0)
                  for (d, _), s in zip(rows, sets, strict=True))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")

    def got():
        return sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in ngram_join.document_links(df).collect())

    assert got() == want
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "COLUMNS", 16)
    assert got() == want
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(df).collect()) == slow_components(rows)


def test_counts_equal_the_pairs_and_odd_rows(spark, monkeypatch):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, text), (1, text), (None, text + " more"), (2, text + " more again"), (3, None), (4, " "), (5, "short")]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], "doc_id bigint, text string, a string, n int, ra int, version string")
    got = sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in ngram_join.document_links(df).collect())
    assert got == [("1", 12, 2), ("1", 12, 2), ("2", 14, 2), ("3", 0, 0), ("4", 0, 0), ("5", 1, 0), ("None", 13, 2)]
    monkeypatch.setattr(ngram_join, "BLOCK", 1)
    pairs = ngram_join.class_links(df).collect()
    assert sorted(r.shared for r in pairs) == [12, 12, 13] and sum(r[2] for r in got if r[0] != "1") + 2 == 2 * len(pairs)
    assert sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in ngram_join.document_links(df).collect()) == got
    assert ngram_join.document_links(df.limit(0)).count() == 0 == ngram_join.class_links(df.limit(0)).count()


def test_components_by_shuffle(spark, monkeypatch):
    """Classes and pairs to verify beyond the broadcast bound."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for g in range(6):
        base = list(rng.choice(words, 60))
        for i in range(6):
            copy = list(base)
            copy[int(rng.integers(60))] = f"x{i}"
            rows.append((10 * g + i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(ngram_join, "BROADCAST_CLASSES", 0)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(df).collect()) == slow_components(rows)
