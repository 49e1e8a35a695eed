"""Language identification with segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces; each language has a probability for
every piece, learned by expectation-maximisation. A text's likelihood under a
language sums over all ways to cut it into pieces. No piece crosses a blank, so
the sum is a product over words, and a forward pass over each distinct word of
a batch gives all factors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from barlake.llm.common import read_table, small_batches, smallest_hashes, typed

#: So many documents of each language are learned from at most, none longer than this.
TRAIN_DOCUMENTS, TRAIN_CHARS = 400, 20_000
EM_ROUNDS = 3
#: Weight of the languages' common distribution, and the probability of a character outside the vocabulary.
SHARED, UNKNOWN = 0.05, 1e-7
#: Probabilities are multiplied by this per character, which keeps products in range.
SCALE = 1e3
#: Words up to each length are padded and scored together; longer ones alone.
LENGTHS = (6, 9, 12, 18, 30, 48)
CACHE_ENTRIES = 300_000
START = "▁"
HELD_OUT_REMAINDER = 2

WORDS = re.compile(r"[^ \t-\r]+")
LETTER = regex.compile(r"\p{L}")

_B = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str) -> list[str]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sorted({model.id_to_piece(i) for i in range(model.get_piece_size())
                   if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))})


def _points(words: list[str], width: int) -> np.ndarray:
    joined = "".join(w.ljust(width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)


class Pieces:
    """The vocabulary; ``len(self)`` stands for a character outside it."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        hashes = np.zeros(len(pieces), np.uint64)
        for size in range(1, self.longest + 1):
            at = [i for i, p in enumerate(pieces) if len(p) == size]
            if at:
                h = np.zeros(len(at), np.uint64)
                for column in _points([pieces[i] for i in at], size).T:
                    h = self._step(h, column)
                hashes[at] = h
        order = np.argsort(hashes)
        self.hashes, self.order = hashes[order], order
        self.present = np.zeros(1 << 20, bool)
        self.present[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.ids)

    @staticmethod
    def _step(h: np.ndarray, points: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (h ^ (points.astype(np.uint64) + np.uint64(1))) * _B
            return h ^ (h >> np.uint64(29))

    def arcs(self, words: list[str], width: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, piece ids) of every piece found in the words."""
        points, out = _points(words, width), []
        sizes = np.array([len(w) for w in words])
        for i in range(width):
            h = np.zeros(len(words), np.uint64)
            for j in range(i, min(width, i + self.longest)):
                h = self._step(h, points[:, j])
                rows = np.flatnonzero(self.present[(h >> np.uint64(44)).astype(np.int64)] & (sizes > j))
                at = np.minimum(np.searchsorted(self.hashes, h[rows]), len(self.hashes) - 1)
                found = self.hashes[at] == h[rows]
                rows, ids = rows[found], self.order[at[found]]
                if j == i:
                    rest = np.setdiff1d(np.flatnonzero(sizes > j), rows)
                    rows = np.concatenate([rows, rest])
                    ids = np.concatenate([ids, np.full(len(rest), len(self))])
                if len(rows):
                    out.append((i, j + 1, rows, ids))
        return out


def _groups(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    sizes = np.array([len(w) for w in words])
    low = -1
    for width in LENGTHS:
        at = np.flatnonzero((sizes > low) & (sizes <= width))
        if len(at):
            yield width, at.tolist()
        low = width


class LanguageModel:
    def __init__(self, pieces: Pieces, languages: list[str], probabilities: np.ndarray):
        """probabilities: a row for each piece and for the unknown character, a column for each language."""
        self.pieces, self.languages, self.p = pieces, languages, probabilities
        self.sizes = np.array([*map(len, pieces.ids), 1])
        self.scaled = probabilities * (SCALE ** self.sizes)[:, None]
        self.cache: dict[str, int] = {}
        self.table = np.empty((CACHE_ENTRIES, len(languages)))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word under each language."""
        out = np.empty((len(words), len(self.languages)))
        for width, at in _groups(words):
            group = [words[i] for i in at]
            ahead = np.zeros((width + 1, len(at), len(self.languages)))
            ahead[0] = 1
            for i, j, rows, ids in self.pieces.arcs(group, width):
                ahead[j, rows] += ahead[i, rows] * self.scaled[ids]
            sizes = np.array([len(w) for w in group])
            out[at] = np.log(ahead[sizes, np.arange(len(at))]) - sizes[:, None] * np.log(SCALE)
        for i, word in enumerate(words):
            if len(word) > LENGTHS[-1]:
                out[i] = self._long(word)
        return out

    def _long(self, word: str) -> np.ndarray:
        ids, longest, scaled = self.pieces.ids, self.pieces.longest, self.scaled
        ahead, shift = [np.ones(len(self.languages))], np.zeros(len(self.languages))
        for end in range(1, len(word) + 1):
            total = np.zeros(len(self.languages))
            for size in range(1, min(longest, len(ahead)) + 1):
                piece = ids.get(word[end - size:end])
                if piece is None and size == 1:
                    piece = len(ids)
                if piece is not None:
                    total = total + ahead[-size] * scaled[piece]
            ahead.append(total)
            if len(ahead) > longest:
                ahead = ahead[-longest:]
                if end % 16 == 0:
                    ahead = [a / total for a in ahead]
                    shift += np.log(total)
        return np.log(ahead[-1]) + shift - len(word) * np.log(SCALE)

    def score(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each text under each language."""
        found = [WORDS.findall(t.lower()) for t in texts]
        out = np.zeros((len(texts), len(self.languages)))
        words = [w for f in found for w in f]
        if not words:
            return out
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        rows = np.array([self.cache.get(w, -1) for w in distinct])
        new = np.flatnonzero(rows < 0)
        values = np.empty((len(distinct), len(self.languages)))
        values[rows >= 0] = self.table[rows[rows >= 0]]
        if len(new):
            values[new] = self.word_scores([START + distinct[i] for i in new])
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                self.cache.clear()
            if len(new) <= CACHE_ENTRIES:
                for i in new:
                    if len(distinct[i]) <= LENGTHS[-1]:
                        self.table[len(self.cache)] = values[i]
                        self.cache[distinct[i]] = len(self.cache)
        at = np.cumsum([0, *map(len, found)])
        full = np.flatnonzero(np.diff(at))
        out[full] = np.add.reduceat(values[codes], at[:-1][full], axis=0)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """``und`` and 0 for a text without a letter; between equals, the first name."""
        marked = [t if t and LETTER.search(t) else "" for t in texts]
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        logs = self.score(marked)
        best = logs.argmax(1)
        share = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
        return ([self.languages[b] if t else "und" for b, t in zip(best, marked, strict=True)],
                [float(s) if t else 0.0 for s, t in zip(share, marked, strict=True)])


def fit(pieces: Pieces, counts: dict[str, Counter], rounds: int = EM_ROUNDS) -> LanguageModel:
    """counts: the words of each language. A round replaces the piece
    probabilities by the pieces' expected shares over all segmentations."""
    languages = sorted(counts)
    words = sorted({START + w for c in counts.values() for w in c if len(w) < LENGTHS[-1]})
    weight = np.array([[counts[name][w[1:]] for name in languages] for w in words], float).reshape(len(words), len(languages))
    p = np.full((len(pieces) + 1, len(languages)), 1 / (len(pieces) + 1))
    p[-1] = UNKNOWN
    groups = [(width, np.array(at), pieces.arcs([words[i] for i in at], width)) for width, at in _groups(words)]
    model = LanguageModel(pieces, languages, p)
    for _ in range(rounds if words else 0):
        expected = np.zeros_like(p)
        for width, at, arcs in groups:
            sizes = np.array([len(words[i]) for i in at])
            ahead = np.zeros((width + 1, len(at), len(languages)))
            back = np.zeros_like(ahead)
            ahead[0] = 1
            back[sizes, np.arange(len(at))] = 1
            for i, j, rows, ids in arcs:
                ahead[j, rows] += ahead[i, rows] * model.scaled[ids]
            for i, j, rows, ids in reversed(arcs):
                back[i, rows] += back[j, rows] * model.scaled[ids]
            factor = weight[at] / back[0]
            for i, j, rows, ids in arcs:
                np.add.at(expected, ids, ahead[i, rows] * model.scaled[ids] * back[j, rows] * factor[rows])
        shared = expected.sum(1, keepdims=True) + 0.01
        shared /= shared.sum()
        own = expected / np.maximum(expected.sum(0), 1e-9)
        p = (1 - SHARED) * own + SHARED * shared
        p[-1] = UNKNOWN
        model = LanguageModel(pieces, languages, p)
    return model


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def training_words(docs: DataFrame) -> dict[str, Counter]:
    """Words of a bounded sample: of each language, the TRAIN_DOCUMENTS distinct
    texts with the smallest hashes among the documents that aren't held out."""
    seen = (docs.where("lang is not null and doc_id is not null").where(~held_out())
            .where(F.length("text").between(1, TRAIN_CHARS))
            .select("lang", "text", F.xxhash64("text").alias("h")))
    counts: dict[str, Counter] = {}
    for row in smallest_hashes(seen, "lang", "h", TRAIN_DOCUMENTS).collect():
        counts.setdefault(row.lang, Counter()).update(WORDS.findall(row.text.lower()))
    return counts


def with_language(docs: DataFrame, vocabulary: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, the columns named
    in ``carry`` (as the struct ``carried``), held_out, the predicted language and
    its posterior probability under equal priors.

    A text that is null or has no letter gets ``und`` and 0; so does every text
    where there is nothing to learn from. A null doc_id isn't held out and isn't
    learned from. Repeated rows each give a row, columns that aren't named are
    ignored, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names = read_pieces(vocabulary)
    fitted = fit(Pieces(names), training_words(typed(docs, doc_id="bigint", text="string", lang="string")))
    shared = spark.sparkContext.broadcast((names, fitted.languages, fitted.p))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("carried"),
    ).withColumn("held_out", held_out())
    schema = StructType([*(rows.schema[c] for c in ("doc_id", "carried", "held_out")),
                         StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, languages, p = shared.value
        model = LanguageModel(Pieces(pieces), languages, p)
        for batch in batches:
            found, scores = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("carried"), batch.column("held_out"),
                 pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "carried", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of ``with_language``."""
    return with_language(docs, vocabulary).drop("carried")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return identify(read_table(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"))
