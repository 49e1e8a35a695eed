"""Registered text queries against their DuckDB SQL and brute force on sf0.001."""
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from barlake.llm import decontam, langid, license_scan, pii, quality, registry
from barlake.llm.common import read_table
from conftest import SF_SMALL

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def test_all_are_registered():
    assert set(registry.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(registry.ORACLE_SQL) <= set(entry.oracle_sql())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, res.fetchall())


def documents(duck):
    return duck.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def test_license_base_by_brute_force(spark, duck):
    got = {r.doc_id: r for r in registry.QUERIES["op1_license_scan"](spark, SF_SMALL).collect()}
    lower = {i: i + 32 for i in range(65, 91)}
    for doc_id, text, _ in documents(duck):
        words = re.findall(license_scan.WORD, text.translate(lower))
        places = [(i, label) for phrase, label in license_scan.BASE_PHRASES for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[doc_id]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert (r.first_word, r.last_word) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_language_on_held_out_rows(spark, duck):
    got = {r.doc_id: r for r in registry.QUERIES["op4_language_id"](spark, SF_SMALL).collect()}
    known = {lang for _, _, lang in documents(duck)}
    right = Counter()
    for doc_id, text, lang in documents(duck):
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == langid.HELD_OUT_REMAINDER)
        assert 0 <= r.score <= 1 and r.lang_pred in known | {"und"}
        right[r.held_out, r.lang_pred == lang] += 1
    assert right[True, True] / (right[True, True] + right[True, False]) >= 0.95


def test_pii_base_by_brute_force(spark, duck):
    forms = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    got = {r.doc_id: r for r in registry.QUERIES["op5_pii"](spark, SF_SMALL).collect()}
    for doc_id, text, _ in documents(duck):
        want = []
        for kind, form in forms.items():
            for m in re.finditer(form, text):
                digits = re.sub("[^0-9]", "", m[0])
                if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                        or kind == "card" and 16 <= len(digits) <= 19 and pii.luhn(digits)
                        or kind == "phone" and 8 <= len(digits) <= 15):
                    want.append((kind, *m.span()))
        assert [s for s in pii.base_spans(text)] == want
        r = got[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in forms]
        assert set(pii.as_text(want).split(",")) <= set(r.spans.split(","))


def test_quality_by_brute_force(spark, duck):
    got = {r.doc_id: r for r in registry.QUERIES["op7_quality_rules"](spark, SF_SMALL).collect()}
    for doc_id, text, _ in documents(duck):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        times = Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
        lines = text.split("\n")
        dups = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r.kept and r.base_failed)


def test_quality_agrees_with_labels(spark, duck):
    got = {r.doc_id: r for r in registry.QUERIES["op7_quality_rules"](spark, SF_SMALL).collect()}
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    agree = [got[d].kept == bool(q) for d, q in labels.items() if not got[d].base_failed]
    assert sum(agree) / len(agree) >= 0.95


def slow_tiling(doc, item, k):
    """Greedy string tiling, word by word."""
    in_doc, in_item, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while (i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]
                       and i + n not in in_doc and j + n not in in_item):
                    n += 1
                if n > best[0]:
                    best = (n, j, i)
        if best[0] < k:
            return tiles
        n, j, i = best
        tiles.append(best)
        in_doc.update(range(i, i + n))
        in_item.update(range(j, j + n))


def test_decontamination_by_brute_force(spark, duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = {(r.doc_id, r.item_id): r for r in registry.QUERIES["op3_decontamination"](spark, SF_SMALL).collect()}
    lower = {i: i + 32 for i in range(65, 91)}

    def cut(text):
        return re.findall(license_scan.WORD, text.translate(lower))

    cut_items = [(i, cut(t)) for i, t in items]
    for doc_id, text, _ in documents(duck):
        words = cut(text)
        runs = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        for item_id, item in cut_items:
            hit = [j for j in range(len(item) - 4) if tuple(item[j:j + 5]) in runs]
            tiles = slow_tiling(words, item, decontam.MIN_TILE) if hit and len(words) < 1500 else None
            if tiles is None:
                if not hit:
                    assert (doc_id, item_id) not in got
                continue
            covered = sum(n for n, _, _ in tiles)
            assert ((doc_id, item_id) in got) == (covered / len(item) >= decontam.MIN_COVER)
            if (doc_id, item_id) in got:
                r = got[doc_id, item_id]
                assert (r.n_item_words, r.n_covered, r.n_tiles) == (len(item), covered, len(tiles))


def test_pages(spark):
    rows = registry.QUERIES["op6_html_extraction"](spark, SF_SMALL).collect()
    assert len(rows) == read_table(spark, SF_SMALL, "pages").count()
    for r in rows:
        assert r.n_chars == len(r.text) > 0 and "<" not in r.text and "track(" not in r.text
        assert r.text == " ".join(r.text.split())


def test_quality_module_has_documented_bounds():
    assert quality.TRAIN_DOCUMENTS and langid.TRAIN_DOCUMENTS and pii.TRAIN_DOCUMENTS
