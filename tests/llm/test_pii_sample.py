"""The training sample holds every kind of span that the corpus has."""
from barlake.llm import pii


def test_rare_kinds_are_drawn(spark, monkeypatch):
    monkeypatch.setattr(pii, "TRAIN_DOCUMENTS", 12)
    monkeypatch.setattr(pii, "KIND_DOCUMENTS", 2, raising=False)
    texts = [f"room {i}" for i in range(500)] + ["mail a@b.org", "host 10.0.0.1", "card 4111 1111 1111 1111", "call +49 30 1234567"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[-4:])], "doc_id bigint, text string")
    got = pii.training_texts(df)
    assert set(texts[-4:]) <= set(got) and len(got) == len(set(got)) == 12
