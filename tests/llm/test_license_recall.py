"""Recall of notices that were altered: words dropped, inserted or replaced, other marks and case."""
import random

from barlake.llm import license_scan


def altered(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(1, len(words) - 1), rng.choice(["drop", "insert", "replace"])
        if kind == "drop":
            del words[at]
        else:
            words[at:at + (kind == "replace")] = [rng.choice(["herein", "shall", "therefore", "2024"])]
    return rng.choice([" ", "  ", "\n", ", "]).join(w.upper() if rng.random() < 0.3 else w for w in words)


def test_recall_of_altered_notices(spark):
    rng = random.Random(4)
    filler = "the words of a text about something else with many plain words in it".split()
    rows, want = [], {}
    for words, label in license_scan.NOTICES:
        for i in range(20):
            text = " ".join(rng.choices(filler, k=12)) + ". " + altered(words.split(), rng, 1) + ". " + " ".join(rng.choices(filler, k=12))
            want[len(rows)] = label
            rows.append((len(rows), text))
    clean = [(1000 + i, " ".join(rng.choices(filler, k=60))) for i in range(50)]
    got = {r.doc_id: r.labels.split(",") for r in license_scan.scan(spark.createDataFrame(rows + clean, "doc_id bigint, text string")).collect()}
    size = {label: min(len(w.split()) for w, own in license_scan.NOTICES if own == label) for label in set(want.values())}

    def recall(ids):
        return sum(want[i] in got[i] for i in ids) / len(ids)
    # one edit costs two word pairs: too many of a notice of 9 words or fewer
    assert recall([i for i in want if size[want[i]] >= 10]) == 1 and recall(list(want)) >= 0.8
    assert all(got[i] == [""] for i, _ in clean)
