"""Secrets and all kinds on texts that weren't trained on; reconciling with base spans."""
import pytest
from pyspark.sql import functions as F

from barlake.llm import pii
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def texts(spark):
    folder = SF_SMALL.replace("0.001", "0.1")
    rows = (spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 8000 and text rlike '[0-9@]'")
            .select("text").distinct().orderBy(F.xxhash64("text")).collect())
    return [r.text for r in rows]


def test_held_out_secrets_are_found(texts):
    half = len(texts) // 2
    train, rest = texts[:half], texts[half:]
    held = [t for t in train if pii.labelled_spans(t)][:150] + [t for t in train if not pii.labelled_spans(t)][:60]
    fitted = pii.Tagger.fresh().fit(*pii.training_windows(held))
    found = pii.find_spans(fitted, rest)
    want = [{x for x in pii.labelled_spans(t) if x[0] == "secret"} for t in rest]
    got = [{x for x in added if x[0] == "secret"} for _, added in found]
    hits, all_ = sum(len(w & g) for w, g in zip(want, got)), sum(map(len, want))
    assert all_ >= 20 and hits >= 0.9 * all_ and sum(map(len, got)) - hits <= 0.1 * all_
    assert all(set(pii.base_spans(t)) == set(base) for t, (base, _) in zip(rest, found))


def test_runs_and_touching_spans():
    runs = [(0, 4), (10, 50)]
    assert pii.whole_run(runs, 12, 20) == (10, 50) and pii.whole_run(runs, 5, 8) == (5, 8) and pii.whole_run([], 1, 2) == (1, 2)
    assert pii._meets([1, 5], [4, 9], 4, 5) is False and pii._meets([1, 5], [4, 9], 3, 5) and pii._meets([1, 2], [40, 41], 30, 31)
    assert pii.fits_form("secret", "a1b2c3d4e5f6a7b8c9d0") and not pii.fits_form("secret", "a" * 40) and not pii.fits_form("secret", "1" * 40)
    long = "9f" * 200_000
    assert pii.labelled_spans(f"key {long} end") == [("secret", 4, 4 + len(long))]
    text = "call +1 (843) 555-7672 or card 4111 1111 1111 1111"
    assert [k for k, _, _ in pii.labelled_spans(text)] == ["card", "phone"]


def test_columns_count_all_spans(spark):
    rows = [(i, f"token = \"{i:04d}ab{'c9d8e7f6a5b4' * 3}\" and mail me{i}@example.org") for i in range(60)] + [(99, None)]
    got = pii.scan_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r in got:
        assert r.n_spans == len([x for x in r.spans.split(",") if x]) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
    assert sum(r.n_added for r in got) >= 54 and {x.split(":")[0] for r in got for x in r.spans.split(",") if x} >= {"email", "secret"}
