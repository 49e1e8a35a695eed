"""Personal data by rules and a character-level bidirectional LSTM with CRF.

The rules give the base spans. The network is trained in numpy from labelled
spans (the base spans of a bounded sample), run over overlapping windows, each
decoded by Viterbi; a character takes its label from the window in which it
stands most centrally, so the windows' answers are reconciled over the whole
text. Spans of the network that pass the kind's form and touch no base span are
added. Besides the kinds of the rules it learns secrets (keys, tokens): runs of
letters and digits that no word looks like.

Every kind's form needs a digit or an ``@``, so windows without one can't add a
span and aren't run.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import read_table, small_batches, stored, typed

KINDS = ("email", "ip", "card", "phone")
#: What the network tags: the rules' kinds and secrets.
TAGS = (*KINDS, "secret")
#: The network is trained on so many distinct documents at most, none longer than this.
TRAIN_DOCUMENTS, TRAIN_CHARS = 400, 20_000
#: Of them, those drawn at most for each kind of span.
KIND_DOCUMENTS = 80
WINDOW, STRIDE = 96, 48
EMBEDDING, HIDDEN, STEPS, BATCH = 12, 16, 160, 64
#: Windows that are run through the network at once.
RUN_AT_ONCE = 1024
#: How central each place of a window is, 1 at its ends.
_CENTRAL = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1).astype(np.int8)

OUT_SCHEMA = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
              "base_sha256 string, spans string, n_added bigint, n_spans bigint")

Span = tuple[str, int, int]

_TRIGGER = re.compile("[0-9@]")
_LOCAL = re.compile("[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't start inside a run of digits that it failed to start at, so the look-behind changes no match.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
#: A secret is a run of at least so many of these characters, with so many digits and letters.
SECRET_CHARS, SECRET_DIGITS, SECRET_LETTERS = 20, 4, 4
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]+")
_LONG_RUN = re.compile(r"[A-Za-z0-9_+/=-]{%d,}" % SECRET_CHARS)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _octets(parts: Iterable[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or "0") <= 255 for p in parts)


def _emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1)  # a local part can't cross this @
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[Span]:
    """By kind, then start."""
    out = _emails(text) if "@" in text else []
    if not _TRIGGER.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m.groups())]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def labelled_spans(text: str) -> list[Span]:
    """What the network learns: the base spans, and whole runs of a secret's form that
    touch none."""
    base = base_spans(text)
    covered = {i for _, a, b in base for i in range(a, b)} if base else set()
    return base + [("secret", *m.span()) for m in _LONG_RUN.finditer(text)
                   if fits_form("secret", m[0]) and covered.isdisjoint(range(*m.span()))]


def fits_form(kind: str, found: str) -> bool:
    """What a span of the network must look like to be added."""
    digits = _NOT_DIGIT.sub("", found)
    if kind == "secret":
        letters = sum(c.isalpha() for c in found)
        return (len(found) >= SECRET_CHARS and len(digits) >= SECRET_DIGITS and letters >= SECRET_LETTERS
                and _SECRET.fullmatch(found) is not None)
    if kind == "email":
        return re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@.]{2,}", found) is not None
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", found) is not None and _octets(found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and re.fullmatch("[0-9 .-]+", found) is not None
    return 8 <= len(digits) <= 15 and re.fullmatch(r"(\+|00|\()[0-9 ()./-]+[0-9]", found) is not None


def as_text(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (TAGS.index(x[0]), x[1], x[2])))


# -- the network ------------------------------------------------------------

#: 0 pads, 1 is any character beyond ASCII, then ASCII.
N_CODES, N_LABELS = 130, 1 + 2 * len(TAGS)


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points + 2, 1).astype(np.int64)


def labels(size: int, spans: Iterable[Span]) -> np.ndarray:
    """0 outside, 1 + 2k where a span of kind k begins, 2 + 2k inside."""
    out = np.zeros(size, np.int64)
    for kind, start, end in spans:
        out[start:end] = 2 + 2 * TAGS.index(kind)
        out[start] -= 1
    return out


def window_starts(size: int, trigger: np.ndarray) -> np.ndarray:
    """Starts of the windows of a text that hold a character of ``trigger``."""
    starts = np.arange(0, max(size - WINDOW + STRIDE, 1), STRIDE)
    held = np.searchsorted(trigger, starts + WINDOW) > np.searchsorted(trigger, starts)
    return starts[held]


def cut(values: np.ndarray, starts: np.ndarray, fill: int = 0) -> np.ndarray:
    padded = np.concatenate([values, np.full(WINDOW, fill, values.dtype)])
    return padded[starts[:, None] + np.arange(WINDOW)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Embedding, an LSTM each way, a dense layer, CRF transitions."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def fresh(cls, seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        at = {"embed": rng.normal(0, 0.5, (N_CODES, EMBEDDING)), "move": np.zeros((N_LABELS, N_LABELS)),
              "out": rng.normal(0, 0.2, (2 * HIDDEN, N_LABELS)), "bias": np.zeros(N_LABELS)}
        at["bias"][0] = 1
        for way in "fb":
            at["w" + way] = rng.normal(0, 0.25, (EMBEDDING + HIDDEN, 4 * HIDDEN))
            at["c" + way] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        return cls({k: v.astype(np.float32) for k, v in at.items()})

    def _lstm(self, x, way, keep):
        n, length, _ = x.shape
        w, c0 = self.p["w" + way], self.p["c" + way]
        into = x @ w[:EMBEDDING] + c0
        h = np.zeros((n, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out, steps = np.empty((n, length, HIDDEN), np.float32), []
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            z = into[:, t] + h @ w[EMBEDDING:]
            gate = _sigmoid(z[:, :3 * HIDDEN])
            f, i, o = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep:
                steps.append((t, f, i, o, g, before, tc, last))
        return out, steps

    def emissions(self, window: np.ndarray, keep: bool = False):
        x = self.p["embed"][window]
        forth, f_steps = self._lstm(x, "f", keep)
        back, b_steps = self._lstm(x, "b", keep)
        both = np.concatenate([forth, back], 2)
        return both @ self.p["out"] + self.p["bias"], (x, both, f_steps, b_steps)

    def decode(self, window: np.ndarray) -> np.ndarray:
        """Viterbi over each window; between equal paths, the smaller label."""
        score, _ = self.emissions(window)
        n, length, _ = score.shape
        best, came = score[:, 0], np.empty((length, n, N_LABELS), np.int8)
        for t in range(1, length):
            paths = best[:, :, None] + self.p["move"]
            came[t] = paths.argmax(1)
            best = paths.max(1) + score[:, t]
        out = np.empty((n, length), np.int64)
        out[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = came[t][np.arange(n), out[:, t]]
        return out

    def gradient(self, window: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood and its gradient."""
        score, (x, both, f_steps, b_steps) = self.emissions(window, True)
        n, length, _ = score.shape
        move = self.p["move"]
        ahead, back = np.empty_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]

        def lse(v, axis):
            top = v.max(axis, keepdims=True)
            return (top + np.log(np.exp(v - top).sum(axis, keepdims=True))).squeeze(axis)

        for t in range(1, length):
            ahead[:, t] = lse(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
        for t in range(length - 2, -1, -1):
            back[:, t] = lse(move + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        total = lse(ahead[:, -1], 1)
        node = np.exp(ahead + back - total[:, None, None])
        pair = np.exp(ahead[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - total[:, None, None, None])
        one = np.eye(N_LABELS, dtype=np.float32)[gold]
        loss = total.sum() - (score * one).sum() - move[gold[:, :-1], gold[:, 1:]].sum()
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["move"] = pair.sum((0, 1)) - np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
        up = node - one
        grad["out"] = np.einsum("nth,ntl->hl", both, up)
        grad["bias"] = up.sum((0, 1))
        up = up @ self.p["out"].T
        dx = np.zeros_like(x)
        for way, steps, part in (("f", f_steps, up[:, :, :HIDDEN]), ("b", b_steps, up[:, :, HIDDEN:])):
            w = self.p["w" + way]
            dh = np.zeros((n, HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, f, i, o, g, before, tc, last in reversed(steps):
                dh = dh + part[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * before * f * (1 - f), dc * g * i * (1 - i),
                                     dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                grad["w" + way][:EMBEDDING] += x[:, t].T @ dz
                grad["w" + way][EMBEDDING:] += last.T @ dz
                grad["c" + way] += dz.sum(0)
                dx[:, t] += dz @ w[:EMBEDDING].T
                dh, dc = dz @ w[EMBEDDING:].T, dc * f
        np.add.at(grad["embed"], window.ravel(), dx.reshape(-1, EMBEDDING))
        return float(loss) / n, {k: v / n for k, v in grad.items()}

    def fit(self, windows: np.ndarray, gold: np.ndarray, steps: int = STEPS, rate: float = 0.02,
            seed: int = 11) -> Tagger:
        """Adam on shuffled batches in which half the windows hold a span."""
        rng = np.random.default_rng(seed)
        rich, poor = (np.flatnonzero((gold > 0).any(1) == x) for x in (True, False))
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(a, BATCH // 2) for a in (rich, poor) if len(a)])
            _, grad = self.gradient(windows[pick], gold[pick])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1, 5 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (
                    np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
        return self


def training_windows(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    windows, gold = [], []
    for text in texts:
        c, marks = codes(text), labels(len(text), labelled_spans(text))
        trigger = np.array([m.start() for m in _TRIGGER.finditer(text)])
        starts = window_starts(len(text), trigger)
        # the text around triggers, cut at several offsets, and its plain beginning
        for shift in (0, 17, 31):
            at = np.unique(np.clip(starts + shift, 0, max(len(text) - 1, 0)))
            windows.append(cut(c, at))
            gold.append(cut(marks, at))
        windows.append(cut(c, np.zeros(1, np.int64)))
        gold.append(cut(marks, np.zeros(1, np.int64)))
    if not windows:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.concatenate(windows), np.concatenate(gold)


def tag_texts(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """The network's spans of each text, before any check of their form."""
    places, windows = [], []
    for i, text in enumerate(texts):
        trigger = np.array([m.start() for m in _TRIGGER.finditer(text)], np.int64)
        if len(trigger):
            starts = window_starts(len(text), trigger)
            places.append((i, starts))
            windows.append((codes(text), starts))
    out: list[list[Span]] = [[] for _ in texts]
    for (i, starts), (c, _) in zip(places, windows, strict=True):
        # the label of the window that holds a place most centrally, whichever run it is in
        label_of, central = np.zeros(len(c), np.int8), np.zeros(len(c), np.int8)
        for a in range(0, len(starts), RUN_AT_ONCE):
            part = starts[a:a + RUN_AT_ONCE]
            for start, path in zip(part, tagger.decode(cut(c, part)), strict=True):
                span = slice(int(start), min(int(start) + WINDOW, len(c)))
                size = span.stop - span.start
                better = _CENTRAL[:size] > central[span]
                central[span][better] = _CENTRAL[:size][better]
                label_of[span][better] = path[:size][better]
        begin = None
        for at in np.flatnonzero(label_of).tolist():
            label = int(label_of[at])
            kind = TAGS[(label - 1) // 2]
            if begin and begin[2] == at and begin[0] == kind and label % 2 == 0:
                begin[2] = at + 1
            else:
                if begin:
                    out[i].append(tuple(begin))
                begin = [kind, at, at + 1]
        if begin:
            out[i].append(tuple(begin))
    return out


def _meets(starts: list[int], reach: list[int], start: int, end: int) -> bool:
    """Whether a stretch touches one of the spans, given their sorted starts and the
    furthest end up to each."""
    at = bisect.bisect_left(starts, end)
    return at > 0 and reach[at - 1] > start


def whole_run(runs: list[tuple[int, int]], start: int, end: int) -> tuple[int, int]:
    """The run of secret characters in which a tagged stretch begins, else the stretch."""
    at = bisect.bisect_right(runs, (start, float("inf"))) - 1
    return runs[at] if at >= 0 and runs[at][1] > start else (start, end)


def find_spans(tagger: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    out = []
    for text, tagged in zip(texts, tag_texts(tagger, texts) if tagger else [[]] * len(texts), strict=True):
        base = base_spans(text)
        runs = [m.span() for m in _SECRET.finditer(text)] if any(k == "secret" for k, _, _ in tagged) else []
        found = {(k, *whole_run(runs, s, e)) if k == "secret" else (k, s, e) for k, s, e in tagged}
        places = sorted((a, b) for _, a, b in base)
        starts, reach = [a for a, _ in places], list(itertools.accumulate((b for _, b in places), max))
        added = [(k, s, e) for k, s, e in sorted(found, key=lambda x: x[1:])
                 if fits_form(k, text[s:e]) and not _meets(starts, reach, s, e)]
        out.append((base, added))
    return out


def training_texts(docs: DataFrame) -> list[str]:
    """A bounded sample of distinct texts, TRAIN_DOCUMENTS at most: of those that hold a
    labelled span of a kind the KIND_DOCUMENTS with the smallest hashes, for each kind, and
    the rest from texts with a digit or an @ but without any."""
    held = (docs.where(F.length("text") <= TRAIN_CHARS).where(F.col("text").rlike("[0-9@]"))
            .select("text", F.xxhash64("text").alias("h")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [sum(1 << TAGS.index(k) for k in {k for k, _, _ in labelled_spans(t)}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(kinds, pa.int32())], names=["h", "kinds"])

    marked = stored(held.mapInArrow(run, "h bigint, kinds int").distinct(), "kinds")

    def smallest(which: Column, n: int) -> set[int]:
        return {r.h for r in marked.where(which).orderBy("h").limit(n).collect()}

    chosen = set().union(*(smallest(F.col("kinds").bitwiseAND(1 << i) != 0, KIND_DOCUMENTS) for i in range(len(TAGS))))
    chosen |= smallest(F.col("kinds") == 0, TRAIN_DOCUMENTS - len(chosen))
    wanted = docs.sparkSession.createDataFrame([(h,) for h in sorted(chosen)], "h bigint")
    return [r.text for r in held.join(F.broadcast(wanted), "h").dropDuplicates(["h"]).orderBy("h").collect()]


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base spans counted by kind,
    the hash of their list, all spans with those the network adds (of the same kinds, or
    ``secret``), and how many were added and are there in all.

    A null text counts as empty and has no spans. A null doc_id stays null,
    repeated rows each give a row, extra columns are ignored, an empty table
    gives an empty result. Where no document of up to TRAIN_CHARS has a base span there
    is nothing to learn, and the base spans are all.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = typed(docs, doc_id="bigint", text="string")
    windows, gold = training_windows(training_texts(docs))
    fitted = Tagger.fresh().fit(windows, gold).p if (gold > 0).any() else None
    shared = spark.sparkContext.broadcast(fitted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for doc_id, (base, added) in zip(batch.column("doc_id").to_pylist(), find_spans(tagger, texts), strict=True):
                count = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((doc_id, *count, hashlib.sha256(as_text(base).encode()).hexdigest(),
                             as_text(base + added), len(added), len(base) + len(added)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [()] * 9,
                    [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2, strict=True)],
                names=[x.split()[0] for x in OUT_SCHEMA.split(", ")])

    return docs.mapInArrow(run, OUT_SCHEMA)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(read_table(spark, sf_dir, "documents"))
