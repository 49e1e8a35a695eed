"""The verdict on labels that it wasn't fitted on."""
from pyspark.sql import functions as F

from barlake.llm import quality
from conftest import SF_SMALL


def test_agrees_with_held_out_labels(spark):
    folder = SF_SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.where("quality is not null and doc_id is not null")
    fitted = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    kept = quality.judge_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels.where(fitted))
    rows = kept.join(labels.where(~fitted).select("doc_id", "quality"), "doc_id").select("kept", "quality").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    right = (sum(good) / len(good) + 1 - sum(bad) / len(bad)) / 2
    print("held out", len(good), len(bad), sum(good) / len(good), 1 - sum(bad) / len(bad), right)
    assert len(good) > 100 and len(bad) > 100 and right >= 0.9
