"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""
import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.llm import chat, components, decontam, html_extract, langid, license_scan, line_dedup, ngram_join, pii, quality
from test_queries import slow_tiling

SCHEMA = ("doc_id bigint, text string, lang string, source string, version string, h bigint, words string, seed string, "
          "`row` string, place string")
LONG = "palabra " * 40_000 + "x" * 60_000
ROWS = [(1, "The first text of some words, and more words to come here.", "en", "a"), (None, "No id for this text.", "en", None),
        (2, None, None, "b"), (3, "", "en", "a"), (3, "", "en", "a"), (4, LONG, "es", "c"), (5, "12345 !!", None, None),
        (6, "Der Text ist deutsch und nicht lang.", "de", "b"), (6, "Der Text ist deutsch und nicht lang.", "de", "b")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "q", "p") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 0, 0), (6, 0, 0), (None, 1, 1), (7, None, 0)], "doc_id bigint, quality int, toxic int")


def both(spark, df, run):
    """Result of the rows, after the result of none has been found empty."""
    assert run(df.limit(0)).count() == 0
    return run(df).collect()


def test_license(spark, docs):
    got = both(spark, docs, license_scan.scan)
    assert len(got) == len(ROWS) and all(r.n_base == 0 and r.labels == "" for r in got)
    text = "MIT License. Apache  License; mit license! " + "Licensed under the Apache License (version 2.0), CC-BY"
    one = spark.createDataFrame([(1, text), (1, text), (2, "the gnu general public" + " license" * 3)], "doc_id bigint, text string")
    rows = license_scan.scan(one).orderBy("doc_id").collect()
    assert rows[0] == rows[1] and len(rows) == 3
    assert (rows[0].n_base, rows[0].first_word, rows[0].base_labels) == (5, 0, "apache,cc-by,mit")
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word, rows[2].score) == (1, 1, 1, 1.0)
    notice = "x permission is hereby granted free of charge to any one person obtaining a copy of this software y"
    r = license_scan.scan(spark.createDataFrame([(1, notice)], "doc_id bigint, text string")).first()
    assert (r.n_base, r.base_labels, r.labels) == (0, "", "mit") and 0.75 <= r.score < 1


def test_chat(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, 0, "user", "q"),
             (2, 1, "assistant", "b"), (2, 2, "user", None), (2, 3, None, "z"), (None, 0, "user", "lost"), (4, None, "user", "n")]
    side = spark.createDataFrame([(*t, "clash") for t in turns], "pair_id bigint, turn bigint, role string, text string, k string")
    other = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "c")], "pair_id bigint, turn bigint, role string, text string")
    got = {r.pair_id: r for r in chat.preference_rows(side, other).collect()}
    assert set(got) == {1, 2, 4}
    one = got[1]
    assert (one.prompt, one.chosen, one.rejected) == ("<|user|>\nq<|end|>\n", "<|assistant|>\na<|end|>\n", "<|assistant|>\nc<|end|>\n")
    start, end = map(int, one.chosen_mask.split(":"))
    assert one.chosen[start:end] == "a<|end|>\n"
    assert (got[2].n_prompt_turns, got[2].prompt, got[2].rejected, got[2].rejected_mask) == (0, "", "", "")
    assert chat.preference_rows(side.limit(0), other.limit(0)).count() == 0
    conv = side.withColumnRenamed("pair_id", "conv_id")
    rows = {r.pair_id: r for r in chat.preference_rows(*chat.preference_sides(conv)).collect()}
    assert set(rows) == {1, 2, 4}


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "some words, and more words to come here"), (2, None), (3, "short one"), (None, ROWS[-1][1]),
                                   (1, "some words, and more words to come here")], "item_id bigint, text string")
    got = both(spark, docs, lambda d: decontam.contaminated(d, items))
    assert sorted((r.doc_id, r.item_id or 0) for r in got) == [(1, 1), (6, 0), (6, 0)] or sorted(
        (r.doc_id, r.item_id or 0) for r in got) == [(1, 1), (1, 1), (6, 0), (6, 0)]
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    half = "one two three four five six seven eight nine ten".split()
    swapped = " ".join(half[5:] + ["and"] + half[:5])
    df = spark.createDataFrame([(1, swapped), (2, " ".join(half[:4]))], "doc_id bigint, text string")
    row = decontam.contaminated(df, spark.createDataFrame([(9, " ".join(half))], "item_id bigint, text string")).collect()
    assert [(r.doc_id, r.n_tiles, r.coverage) for r in row] == [(1, 2, 1.0)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=20))
def test_tiling_equals_brute_force(doc, item):
    a, b = (np.array(x, np.uint64) for x in (doc, item))
    assert decontam.tiling(a, b, decontam.MIN_TILE) == slow_tiling(doc, item, decontam.MIN_TILE)


def test_language(spark, docs):
    got = both(spark, docs, lambda d: langid.identify(d, public.path("piece_bpe_32k.model")))
    assert len(got) == len(ROWS)
    by = [(r.doc_id, r.lang_pred, r.held_out) for r in got]
    assert by[2][1] == by[3][1] == by[6][1] == "und" and by[1][2] is False
    none = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.identify(none, public.path("piece_bpe_32k.model")).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(["▁", "a", "b", "ab", "▁a", "ba", "aba"])
    p = np.linspace(0.05, 0.2, 8)[:, None] * np.array([[1, 0.5]])
    model = langid.LanguageModel(pieces, ["x", "y"], p)

    def total(word, k):
        return 1.0 if not word else sum(
            p[pieces.ids.get(word[:n], len(pieces)), k] * total(word[n:], k)
            for n in range(1, len(word) + 1) if n == 1 or word[:n] in pieces.ids)

    words = ["▁abab", "▁a", "▁cabac", "▁ababababab"]
    want = [[np.log(total(w, k)) for k in (0, 1)] for w in words]
    assert np.allclose(model.word_scores(words), want)
    assert np.allclose([model._long(w) for w in words], want)
    long = "▁" + "abac" * 30
    assert np.allclose(model._long(long), model.word_scores([long])[0])


def test_pii(spark, docs):
    got = both(spark, docs, pii.scan_documents)
    assert len(got) == len(ROWS) and all(r.spans == "" and r.n_email == 0 for r in got)


@settings(max_examples=300, deadline=None)
@given(st.text("a1.@+- ()9", max_size=60))
def test_pii_rules_equal_plain_patterns(text):
    import re
    want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    want += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
             if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and pii.luhn(d)]
    want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
             if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    assert pii.base_spans(text) == want


def test_tagger_gradient_and_learning():
    rng = np.random.default_rng(3)
    tagger = pii.Tagger.fresh()
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    window, gold = rng.integers(0, pii.N_CODES, (2, 6)), rng.integers(0, pii.N_LABELS, (2, 6))
    _, grad = tagger.gradient(window, gold)
    for name, at in (("wf", (3, 5)), ("wb", (20, 50)), ("move", (1, 2)), ("out", (4, 3)), ("cf", (7,)), ("embed", (int(window[0, 0]), 2))):
        old = tagger.p[name][at]
        sides = []
        for step in (1e-3, -1e-3):
            tagger.p[name][at] = old + step
            sides.append(tagger.gradient(window, gold)[0])
        tagger.p[name][at] = old
        assert abs((sides[0] - sides[1]) / 2e-3 - grad[name][at]) < 1e-2 * max(1, abs(grad[name][at]))
    texts = [f"words before {rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)}.{rng.integers(1, 255)} and after it"
             f" mail{rng.integers(99)}@host{rng.integers(9)}.example.com end." for _ in range(120)]
    fitted = pii.Tagger.fresh().fit(*pii.training_windows(texts[:100]))
    found = pii.tag_texts(fitted, texts[100:])
    want = [pii.base_spans(t) for t in texts[100:]]
    hit = sum(set(w) <= set(f) for w, f in zip(want, found, strict=True))
    assert hit >= 14


def test_pages():
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a>Home</a></li></ul></nav><div class="cookie-notice">ok?</div>
    <article><h1>A &amp; B</h1><p><b>One <p>two&nbsp;<i>th</i>ree<script>var x="</p>";</script><form><p>mail</form><div class="ad">buy</div>
    <ul><li>x<li>y</ul><section id="comments"><p>me too</p></section></article><footer>&copy; f"""
    assert html_extract.extract(page) == "A & B One two three x y"
    assert html_extract.extract("") == "" and html_extract.extract("<p>a<p>b<a href='x>y") == "a b"
    assert html_extract.extract("1 < 2 <b>x</b>y <!-- z") == "1 < 2 xy"
    assert html_extract.extract("<a " * 50_000) == "" and html_extract.extract("<b>" * 3_000 + "x") == "x"


def test_wrapper_is_a_union_free_expression():
    def page(items, note, body):
        extra = f"<div>{note}</div>" if note else ""
        return f"<body><ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>{extra}<div class=m><p>{body}</p></div></body>"

    pages = [page("ab", "Same", "one"), page("abc", "Same", "two"), page("a", "", "three"), page("ab", "Same", "four")]
    made = html_extract.align(html_extract.wrapper_of(html_extract.parse(p)) for p in pages)
    assert html_extract.as_regex(made) == "<body><ul>(<li>#</li>)+</ul>(<div>text</div>)?<div.m><p>#</p></div></body>"
    places = html_extract.template_places(made)
    assert [html_extract.extract(p, places) for p in pages] == ["a b one", "a b c two", "a three", "a b four"]
    copies = html_extract.align(html_extract.wrapper_of(html_extract.parse(pages[0])) for _ in range(4))
    assert not html_extract.template_places(copies)


def test_page_rows(spark):
    rows = [(1, "http://h.org/a", "<p>x</p>"), (None, None, None), (2, "nonsense", "<main>y</main>"), (2, "nonsense", "<main>y</main>"),
            (3, "http://h.org/b", "z" * 300_000)]
    df = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id bigint, url string, html string, host string, version string")
    got = both(spark, df, html_extract.extract_pages)
    assert sorted(((r.page_id or 0), r.n_chars) for r in got) == [(0, 0), (1, 1), (2, 1), (2, 1), (3, 300_000)]


def test_quality(spark, docs, labels):
    got = both(spark, docs, lambda d: quality.judge_documents(d, labels))
    assert len(got) == len(ROWS) and [r.n_words for r in got][2:4] == [0, 0] and not any(r.kept for r in got if r.n_words < 20)
    assert len(quality.judge_documents(docs, labels.limit(0)).collect()) == len(ROWS)


def test_field_marginals_and_viterbi_by_enumeration():
    import itertools
    rng = np.random.default_rng(5)
    field = quality.LineField(rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(1, 5, quality.N_FEATURES))
    score = (x @ field.weights)[0]
    paths = list(itertools.product((0, 1), repeat=5))
    logs = np.array([sum(score[t, s] for t, s in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
    prob = np.exp(logs - logs.max())
    prob /= prob.sum()
    node, move = field._marginals(x, np.ones((1, 5), bool))
    assert np.allclose(node[0, 2, 1], sum(q for p, q in zip(paths, prob) if p[2] == 1))
    assert np.allclose(move[0, 1, 0, 1], sum(q for p, q in zip(paths, prob) if p[1:3] == (0, 1)))
    assert tuple(field.decode(x[0])) == paths[int(logs.argmax())]


def test_line_dedup(spark, docs):
    got = both(spark, docs, line_dedup.deduplicated)
    assert len(got) == len(ROWS) and all(r.n_removed == 0 for r in got)
    rows = [(i, f"own {i}\n  shared line\t\n\nfour" if i < 4 else f"own {i}\nshared line", f"s{i}" if i else None) for i in range(8)]
    df = spark.createDataFrame([*rows, rows[7], (9, None, "s9"), (10, "\n", "s10")], "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in line_dedup.deduplicated(df, 5).collect()}
    assert got[0].text == rows[0][1] and got[1].text == "own 1\n\nfour" and got[7].text == "own 7"
    assert (got[1].n_lines, got[1].n_removed, got[9].text, got[10].text) == (4, 1, None, "\n")


@pytest.mark.parametrize("sites", [4, 5, 6, 40])
def test_line_dedup_threshold(spark, sites):
    df = spark.createDataFrame([(i, "same", f"s{i % sites}") for i in range(2 * sites)], "doc_id bigint, text string, source string")
    assert sum(r.n_removed for r in line_dedup.deduplicated(df, 5).collect()) == (2 * sites - 1 if sites >= 5 else 0)


def slow_components(rows):
    import re
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(least.get(top(i)))) for i, (d, _) in enumerate(rows))


def components_of(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, a string, h bigint")
    assert ngram_join.components(df.limit(0)).count() == 0
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.components(df).collect())


def test_ngram_join_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = list(rng.choice(words, rng.integers(5, 90)))
        for _ in range(int(rng.integers(1, 25))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(len(copy)))] = str(rng.choice(words))
            rows.append((len(rows) + 100, " ".join(copy)))
    passage = " ".join(rng.choice(words, 40))
    rows += [(1000 + i, " ".join(rng.choice(words, 60)) + " " + passage) for i in range(30)]
    rows += [(7, None), (8, ""), (9, "One two"), (10, "one  two"), (10, "one two"), (None, "one two"), (None, "alone here"), (11, "a b c d"),
             (12, "A b\tc d"), (13, "x y z u v"), (13, rows[0][1].upper())]
    assert components_of(spark, rows) == slow_components(rows)
    monkeypatch.setattr(ngram_join, "FULL_COLUMN", 2)
    monkeypatch.setattr(ngram_join, "FREQUENT_DOCUMENTS", 5)
    assert components_of(spark, rows) == slow_components(rows)


def test_ngram_join_chain(spark):
    """Neighbours of a long chain link, its ends don't; columns are long."""
    line = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(line[4 * i:4 * i + 100])) for i in range(60)]
    assert components_of(spark, rows) == slow_components(rows)


def test_sketches_bound_the_overlap():
    rng = np.random.default_rng(4)
    for size in (0, 1, 3, 500, 3_000, 9_000, 200_000):
        x = np.unique(rng.integers(1, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[::3], rng.integers(1, 1 << 63, size // 2 + 1).astype(np.uint64)]))
        (coarse, _), (fine, fine2) = ngram_join.sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        other = ngram_join.sketches(y, np.array([0, len(y)]))[0][0]
        shared = len(np.intersect1d(x, y))
        assert shared <= ngram_join.most_shared(fine or coarse, fine2 or other) and shared <= ngram_join.most_shared(fine or coarse, other)
        assert ngram_join.most_shared(fine or coarse, fine or coarse) >= len(x)
    far = [np.unique(rng.integers(1, 1 << 63, 9_000).astype(np.uint64) * np.uint64(2)) for _ in (0, 1)]
    _, fine = ngram_join.sketches(np.concatenate(far), np.array([0, len(far[0]), sum(map(len, far))]))
    assert ngram_join.most_shared(*fine) < 0.857 * len(far[0])


def test_summary_keeps_frequent_hashes(monkeypatch):
    monkeypatch.setattr(ngram_join, "SUMMARY", 50)
    rng = np.random.default_rng(2)
    summary = ngram_join._Summary()
    for _ in range(200):
        summary.add(np.unique(np.concatenate([rng.integers(1 << 20, 1 << 60, 30).astype(np.uint64), np.array([1, 2], np.uint64)])))
    summary.merge()
    assert {1, 2} <= set(summary.keys.tolist()) and len(summary.keys) <= 50


def test_roots(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 5)]
    got = dict(components.roots(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {**{i: 0 for i in range(31)}, 300: 0, **{i: 100 for i in range(100, 140)}}
    assert components.roots(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
