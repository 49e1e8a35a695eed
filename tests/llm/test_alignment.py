"""Alignment against a byte-by-byte brute force, both ways of joining pair counts, odd rows."""
import hashlib
from collections import Counter

import pytest
import public_tokenizers as public
import sentencepiece
from tokenizers import Tokenizer

from barlake.llm import alignment

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
TEXTS = ["Some words, and some more words.", "Some words, and some more words.", "naïve café — 東京 🙂\n\n x", "", None, "▁lower block",
         "<s>special</s> <0x41> <|endoftext|>", "a" * 3000, "tab\tand  two  spaces ", "word " * 4000, "\u0000 \r\n", "ends in space "]


def slow(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum and groups of each text."""
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    back = alignment.byte_letters()
    per = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        bytes_a = [bytes(back[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else
                   b_lib.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            per.append(([], [], [], []))
            continue
        own_a = [k for k, t in enumerate(bytes_a) for _ in t]
        own_b = [k for k, t in enumerate(bytes_b) for _ in t]
        links = sorted(set(zip(own_a, own_b)))
        groups, i, j = [], 0, 0
        for at in range(1, len(raw) + 1):
            if at == len(raw) or (own_a[at] != own_a[at - 1] and own_b[at] != own_b[at - 1]):
                groups.append((a[i:own_a[at - 1] + 1], b[j:own_b[at - 1] + 1]))
                i, j = own_a[at - 1] + 1, own_b[at - 1] + 1
        per.append((a, b, groups, [(a[x], b[y]) for x, y in links]))
    count = Counter(p for *_, links in per for p in links)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(n, most.get(y, 0))
    out = []
    for a, b, groups, links in per:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
    rows = [(i if i != 1 else None, t, "clash", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, n_a int")
    got = sorted(map(tuple, alignment.alignment(docs, A, public.PATTERN, B).collect()), key=str)
    assert got == sorted([(r[0], *m) for r, m in zip(rows, slow(TEXTS))], key=str)
    assert any(r[1] for r in got) and sum(r[1] == 0 for r in got) == 3


def test_whole_query_equals_brute_force(spark):
    from conftest import SF_SMALL
    got = {r[0]: tuple(r)[1:] for r in alignment.op11_tokenizer_alignment(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == dict(zip([r.doc_id for r in rows], slow([r.text for r in rows])))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.alignment(docs, A, public.PATTERN, B).count() == 0


def test_ids_out_of_merge_order_are_refused(tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}')
    with pytest.raises(ValueError, match="order of merges"):
        alignment.read_byte_level(str(path))
