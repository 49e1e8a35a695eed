"""Cross-tokenizer alignment after exact-text deduplication.

Rows are shuffled by their full text, so that each distinct text is tokenised and
aligned once. Its counts of linked id pairs are weighted by its copies, summed over
the corpus, and come back to the text; the measures are joined to the documents
by the text's digest.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import looked_up, read_table, small_batches, stored, typed

#: Distinct id pairs that are broadcast at most; beyond it they're joined by shuffle.
BROADCAST_PAIRS = 1_000_000

MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes
    of Latin-1 stand for themselves, the others for letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_byte_level(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file, without its special tokens. The
    ids of merged tokens must stand in the order of their merges: then merging by
    id is merging by rank."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, vocabulary = byte_letters(), spec["model"]["vocab"]
    special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    order = [vocabulary["".join(m)] for m in merges]
    if any(a >= b for a, b in zip(order, order[1:])):
        raise ValueError(f"{path}: ids of merged tokens are not in the order of merges")
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, model: bytes):
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = {i: token for token, i in ranks.items()}
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.length_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.length_a[list(self.bytes_a)] = [len(t) for t in self.bytes_a.values()]
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # each id as text inside a group and at the end of its side of it
        top = len(self.length_a)
        self.written = [f"{i}{end}" for i in range(top) for end in ",|"] + [f"{i}{end}" for i in range(len(self.bytes_b)) for end in ",;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both for each text; none where their bytes aren't space + text."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            raw = (" " + text).encode()
            a = self.a.encode_ordinary(" " + text)
            same = text and b"".join(map(self.bytes_b.__getitem__, b)) == raw == b"".join(map(self.bytes_a.__getitem__, a))
            yield (a, b) if same else ([], [])

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the groups in ``a`` and in ``b``, and the places of both tokens of every
        link: each stretch between two neighbouring token ends lies in one token of
        either."""
        ends_a, ends_b = self.length_a[a].cumsum(), self.length_b[b].cumsum()
        mark = np.zeros(ends_a[-1] + 1, np.int8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        ends = mark[np.flatnonzero(mark)]
        in_a, in_b = ends & 1, ends >> 1
        stops_a, stops_b = in_a.cumsum(), in_b.cumsum()
        both = ends == 3
        return stops_a[both], stops_b[both], stops_a - in_a, stops_b - in_b

    def groups_text(self, a: np.ndarray, b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group's sides, written in their order."""
        codes = np.empty(len(a) + len(b), np.int64)
        for ids, stops, before, base in ((a, stops_a, np.append(0, stops_b[:-1]), 0), (b, stops_b, stops_a, 2 * len(self.length_a))):
            sizes = np.diff(stops, prepend=0)
            own = base + 2 * ids
            own[stops - 1] += 1
            codes[np.arange(len(ids)) + np.repeat(before, sizes)] = own
        return "".join(map(self.written.__getitem__, codes.tolist()))[:-1]


_pairs: dict[str, Pair] = {}


def _pair(key: str, ranks: dict[bytes, int], pattern: str, model: bytes) -> Pair:
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(ranks, pattern, model)
    return _pairs[key]


def aligned_texts(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> tuple[DataFrame, int]:
    """A stored row per distinct text (not null, not empty): ``digest``, ``copies``, its
    measures and groups, and its distinct id pairs as ``a * width + b`` with their
    numbers of links; and ``width``, the size of the second vocabulary."""
    spark = docs.sparkSession
    small_batches(spark)
    ranks = read_byte_level(a_path)
    with open(b_path, "rb") as f:
        model = f.read()
    width = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    key = hashlib.sha256(repr(sorted(ranks.items())).encode() + pattern.encode() + model).hexdigest()
    shared = spark.sparkContext.broadcast((ranks, pattern, model))
    kind, arrow = ("int", pa.int32()) if (max(ranks.values()) + 1) * width < 2 ** 31 else ("bigint", pa.int64())
    texts = docs.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(key, *shared.value)
        for batch in batches:
            rows = []
            for a, b in pair.tokens(batch.column("text").to_pylist()):
                if not a:
                    rows.append((0, 0, 0, 0, "", [], []))
                    continue
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                stops_a, stops_b, at_a, at_b = pair.align(a, b)
                pairs, links = np.unique(a[at_a] * width + b[at_b], return_counts=True)
                groups = hashlib.sha256(pair.groups_text(a, b, stops_a, stops_b).encode()).hexdigest()
                rows.append((len(a), len(b), len(stops_a), len(at_a), groups, pairs, links))
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("copies"), *[pa.array(c, pa.int64()) for c in columns[:4]],
                 pa.array(columns[4], pa.string()), pa.array(columns[5], pa.list_(arrow)), pa.array(columns[6], pa.list_(pa.int32()))],
                names=["digest", "copies", *MEASURES, "groups_sha256", "pairs", "links"])

    rows = texts.select(F.sha2("text", 256).alias("digest"), "copies", "text").mapInArrow(
        run, "digest string, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             f"groups_sha256 string, pairs array<{kind}>, links array<int>")
    return stored(rows, "aligned"), width


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """A row per linked id pair: ``pair``, ``total`` links over all documents, whether no
    pair of its second id has more (``best``), and how many ``texts`` hold it. A second
    id has at most as many pairs as the first vocabulary has ids."""
    each = aligned.select("copies", F.explode(F.arrays_zip("pairs", "links")).alias("at"))
    counted = each.groupBy(F.col("at.pairs").alias("pair")).agg(
        F.sum(F.col("copies") * F.col("at.links")).alias("total"), F.count(F.lit(1)).alias("texts"))
    most = F.max("total").over(Window.partitionBy(F.pmod("pair", F.lit(width))))
    return stored(counted.withColumn("best", F.col("total") == most), "pairs")


def alignment(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): tokens, groups and links of the
    byte-level file (of space + text) against the piece model, how many links have
    their second id's highest count over all documents, and the counts' sum.

    Special tokens' strings are plain text. A null or empty text, or one that either
    tokenizer doesn't give back byte for byte, has no tokens: zeros and ''. Null
    doc_ids stay null, repeated rows count again and each give a row, extra
    columns are ignored, an empty table gives an empty result.
    """
    docs = typed(docs, doc_id="bigint", text="string")
    aligned, width = aligned_texts(docs, a_path, pattern, b_path)
    pairs = pair_counts(aligned, width)
    each = aligned.select("digest", F.explode(F.arrays_zip("pairs", "links")).alias("at")).select(
        "digest", F.col("at.pairs").alias("pair"), F.col("at.links").alias("links"))
    if pairs.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        each = each.join(F.broadcast(pairs.drop("texts")), "pair")
    else:
        each = looked_up(each, pairs, "pair", "texts", "inner")
    sums = each.groupBy("digest").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("total")).alias("count_sum"))
    measured = stored(aligned.drop("pairs", "links").join(sums, "digest"), "measures")
    keyed = docs.select("doc_id", F.sha2("text", 256).alias("digest"))
    found = looked_up(keyed, measured, "digest", "copies")
    return found.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in (*MEASURES, "n_best", "count_sum")],
                        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return alignment(read_table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.json"), public.PATTERN,
                     public.path("piece_bpe_32k.model"))
