"""The pipeline's stages on a small corpus with planted cases, and as a whole."""
import numpy as np
import tiktoken
import public_tokenizers as public

from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import bpe
from conftest import SF_SMALL


def test_stages_on_planted_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = docs.where("lang = 'en' and length(text) between 900 and 3000").orderBy("doc_id").limit(3).collect()
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").where("length(text) > 60").orderBy("item_id").first().text
    clean = words[0].text
    base = [w for w in words[1].text.split() if w]
    near = list(base)
    near[len(near) // 2] = "changed"
    planted = [(100001, "1234 !! 5678", "xx", "p1"), (100002, " ".join(base), "en", "p1"), (100003, " ".join(near), "en", "p2"),
               (100004, " ".join(reversed(clean.split())) + " " + item, "en", "p3")]
    planted += [(100010 + i, f"Accept our cookies to read on.\n{w} stands here alone with words of its own {i}.", "en", f"q{i}")
                for i, w in enumerate(base[:6])]
    added = spark.createDataFrame([(*p, len(p[1])) for p in planted], docs.schema)
    docs = docs.unionByName(added)
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).checkpoint()
        assert docs.columns == columns, name
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert 100001 not in kept["language ID"] and 100002 in kept["language ID"]
    assert kept["line dedup"][100010].startswith("Accept") and all("cookies" not in kept["line dedup"][100010 + i] for i in range(1, 6))
    near_copies = {words[1].doc_id, 100002, 100003}
    assert near_copies & set(kept["n-gram join"]) == {words[1].doc_id}
    assert 100004 in kept["n-gram join"] and 100004 not in kept["decontamination"]
    assert {words[0].doc_id, words[1].doc_id} <= set(kept["decontamination"])


def test_run(spark):
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken")),
                                special_tokens={})
    texts = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert 0.3 * len(texts) < len(rows) < len(texts) and len({r.doc_id for r in rows}) == len(rows)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.round_trip and library.encode_ordinary(library.decode(ids)) == ids
        assert set(library.decode(ids).split("\n")) <= set(texts[r.doc_id].split("\n"))


def test_odd_tables(spark):
    """Clashing names, null texts and ids, repeated rows, and no rows at all."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    names = ["version", "n_lines", "n_removed", "gone", "cut_id", "carried", "_id", "_version", "_salt", "place"]
    odd = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    odd = odd.unionByName(odd.limit(2)).unionByName(odd.limit(2).withColumn("text", F.lit(None).cast("string")))
    odd = odd.unionByName(odd.limit(1).withColumn("doc_id", F.lit(None).cast("bigint"))).checkpoint()
    kept, none = odd, odd.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept, none = (stage(spark, d, SF_SMALL).checkpoint() for d in (kept, none))
        assert kept.columns == none.columns == odd.columns and none.count() == 0, name
        assert kept.select(*names).distinct().collect() == [tuple(range(len(names)))], name
    assert 0 < kept.count() <= 60 and kept.where("text is null").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL).count() == kept.count()
