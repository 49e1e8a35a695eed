"""Quality rules with line sequence labelling.

Counts of words, symbols, repeated lines and repeated 8-word windows are exact.
Each line is then marked content or boilerplate by Viterbi decoding of a
linear-chain conditional random field; the content's share of the characters
decides retention.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import read_table, small_batches, smallest_hashes, typed

#: The field is fitted on so many labelled documents of each class at most,
#: none longer than this.
TRAIN_DOCUMENTS, TRAIN_CHARS = 300, 20_000
WINDOW_WORDS, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Share of the characters that must stand in content lines.
CONTENT_SHARE = 0.5

WORDS = re.compile(r"[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_MARKS = re.compile(r"[!?]")
_DIGITS = re.compile(r"[0-9]")
N_FEATURES = 10

OUT_SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
              "n_repeat_words bigint, base_failed boolean, kept boolean, content_share double")


def repeated_words(words: list[str], size: int = WINDOW_WORDS) -> int:
    """Words that stand in a window of ``size`` words found twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.uint64)
    window = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            window = (window + codes[j:j + n] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ordered = np.sort(window)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    # equal sums may in theory be different windows: number equal windows exactly by doubling
    exact, width = codes.astype(np.int64), 1
    while width < size:
        pair = exact[:-width] * (int(exact.max()) + 1) + exact[width:]
        exact, width = np.unique(pair, return_inverse=True)[1], 2 * width
    again = np.bincount(exact)[exact] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    words = WORDS.findall(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dups += 1
        elif WORDS.search(line):
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dups,
            repeated_words(words))


def line_features(lines: list[str]) -> np.ndarray:
    out = np.empty((len(lines), N_FEATURES), np.float32)
    for i, line in enumerate(lines):
        words = line.split()
        n, chars = max(len(words), 1), max(len(line), 1)
        symbols = sum(map(line.count, SYMBOLS))
        out[i] = (1.0, min(10 * symbols / chars, 2), sum(map(str.isupper, words)) / n,
                  min(5 * len(_MARKS.findall(line)) / n, 2), len(set(words)) / n,
                  min(5 * len(_DIGITS.findall(line)) / chars, 2), min(chars / n / 10, 2),
                  min(n / 20, 2), line.rstrip()[-1:] in (".", "!", "?", ":"), line[:1].isupper())
    return out


def worded_lines(text: str) -> list[str]:
    return [line for line in text.split("\n") if WORDS.search(line)]


class LineField:
    """Linear-chain conditional random field of two states, 1 being content."""

    def __init__(self, weights=None, moves=None):
        self.weights = np.zeros((N_FEATURES, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def fit(self, sequences: list[np.ndarray], states: list[int], steps: int = 150, rate: float = 0.1,
            decay: float = 1e-3) -> LineField:
        """Adam on the mean log-likelihood; all lines of a sequence have its label."""
        longest = max(map(len, sequences))
        x = np.zeros((len(sequences), longest, N_FEATURES))
        here = np.zeros((len(sequences), longest), bool)
        for i, s in enumerate(sequences):
            x[i, :len(s)], here[i, :len(s)] = s, True
        gold = np.zeros((len(sequences), longest, 2))
        gold[np.arange(len(states)), :, states] = 1
        gold *= here[:, :, None]
        weight = 1 / here.sum(1)  # each document counts alike
        share = np.array(states, float)
        weight *= np.where(share == 1, 1 / max(share.sum(), 1), 1 / max((1 - share).sum(), 1)) / 2
        first = [np.zeros_like(p) for p in (self.weights, self.moves)]
        second = [np.zeros_like(p) for p in (self.weights, self.moves)]
        both = here[:, 1:] & here[:, :-1]
        pairs = np.zeros((2, 2))
        for s in (0, 1):
            rows = np.array(states) == s
            pairs[s, s] = (both[rows] * weight[rows, None]).sum()
        for step in range(1, steps + 1):
            node, move = self._marginals(x, here)
            move *= (both * weight[:, None])[:, :, None, None]
            up = [np.einsum("nlf,nls->fs", x, (gold - node) * weight[:, None, None]) - decay * self.weights,
                  pairs - move.sum((0, 1)) - decay * self.moves]
            for p, g, m, v in zip((self.weights, self.moves), up, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def _marginals(self, x, here):
        score = x @ self.weights
        n, length, _ = score.shape
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, length):
            new = np.logaddexp(*(ahead[:, t - 1, i, None] + self.moves[i] for i in (0, 1))) + score[:, t]
            ahead[:, t] = np.where(here[:, t, None], new, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            into = score[:, t + 1] + back[:, t + 1]
            new = np.logaddexp(*(into[:, j, None] + self.moves[:, j] for j in (0, 1)))
            back[:, t] = np.where(here[:, t + 1, None], new, back[:, t + 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        node = np.exp(ahead + back - total[:, None, None]) * here[:, :, None]
        move = np.exp(ahead[:, :-1, :, None] + self.moves + (score + back)[:, 1:, None, :]
                      - total[:, None, None, None])
        return node, move

    def decode(self, features: np.ndarray) -> list[int]:
        """Viterbi; between equal paths, content."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        scores = (features @ self.weights).tolist()
        a, b = scores[0]
        steps = []
        for s0, s1 in scores[1:]:
            from1, to1 = b + m10 >= a + m00, b + m11 >= a + m01
            a, b = (b + m10 if from1 else a + m00) + s0, (b + m11 if to1 else a + m01) + s1
            steps.append((from1, to1))
        state = int(b >= a)
        path = [state]
        for came in reversed(steps):
            state = int(came[state])
            path.append(state)
        return path[::-1]


def training_rows(docs: DataFrame, labels: DataFrame) -> list:
    """A bounded sample of labelled documents: of each class, the
    TRAIN_DOCUMENTS whose ids have the smallest hashes."""
    found = (typed(labels, doc_id="bigint", quality="int").where("doc_id is not null and quality in (0, 1)")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("h", F.xxhash64("doc_id")))
    chosen = smallest_hashes(found, "quality", "h", TRAIN_DOCUMENTS).select("doc_id", "quality")
    return (docs.where(F.length("text").between(1, TRAIN_CHARS))
            .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
            .orderBy(F.xxhash64("doc_id")).collect())


def fit_field(docs: DataFrame, labels: DataFrame) -> LineField | None:
    """None where one class has no document: then the base rules decide alone."""
    found = [(line_features(lines), row.quality) for row in training_rows(docs, labels)
             if (lines := worded_lines(row.text))]
    if len({state for _, state in found}) < 2:
        return None
    return LineField().fit([x for x, _ in found], [s for _, s in found])


def content_share(field: LineField | None, text: str) -> float:
    lines = worded_lines(text)
    if field is None or not lines:
        return float(bool(lines))
    sizes = np.array([len(line) for line in lines])
    return float((sizes * field.decode(line_features(lines))).sum() / sizes.sum())


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the base counts, the
    base verdict and the final one.

    A null text has no words and fails the base rules, as an empty one does. A
    null doc_id stays null; repeated rows each give a row; extra columns are
    ignored; empty tables give an empty result. Without labels of both classes
    a document is kept unless the base rules fail it.
    """
    small_batches(docs.sparkSession)
    docs = typed(docs, doc_id="bigint", text="string")
    field = fit_field(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                counts = base_counts(text)
                failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
                share = content_share(field, text)
                rows.append((doc_id, *counts, failed, not failed and share >= CONTENT_SHARE, share))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [()] * 9,
                    [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()], strict=True)],
                names=[x.split()[0] for x in OUT_SCHEMA.split(", ")])

    return docs.mapInArrow(run, OUT_SCHEMA)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
