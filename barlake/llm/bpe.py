"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved until a part is a leaf. A leaf is cut into pieces by the
pattern, and each piece is merged by rank. Two neighbours are joined by
scanning a window around their border again, growing it until a piece border
of the new scan meets one of the right neighbour: the pattern looks only ahead,
so from a common border on both scans go the same way, and left of the window
no match had looked as far as the border.

Inside one long piece the parts are token sequences. They are joined by
merging the bytes of a window around the border again, growing it until its
outer tokens are compatible with their neighbours. Two tokens are compatible
if merging their joint bytes gives back the same two; a sequence whose
adjacent pairs are all compatible is the encoding of its bytes, so the tokens
outside the window are final.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from barlake.llm.common import read_table, small_batches, typed

#: Characters of a leaf of the text tree, bytes of a leaf inside a piece, ids of a leaf of decoding.
LEAF_CHARS, LEAF_BYTES, LEAF_IDS = 1 << 15, 64, 1 << 15
#: How far beyond its end a match of the pattern can look.
LOOKAHEAD = 3
CACHE_ENTRIES = 400_000

OUT_SCHEMA = ("doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
              "n_bytes bigint, round_trip boolean")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class _Cache(dict):
    """piece -> its ids as bytes; emptied when full, so its memory is bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        got = np.array(self.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = got
        return got


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.scan = regex.compile(pattern)
        self.pieces = _Cache(self.encode_piece)
        self.pairs: dict[tuple[int, int], bool] = {}

    # -- inside a piece ---------------------------------------------------

    def merge(self, raw: bytes) -> list[int]:
        """Merge adjacent parts, lowest rank first and leftmost among equals."""
        if len(raw) > LEAF_BYTES:
            return self._merge_heap(raw)
        ranks = self.ranks
        parts = [raw[i:i + 1] for i in range(len(raw))]
        near = [ranks.get(raw[i:i + 2]) for i in range(len(raw) - 1)]
        while near:
            best, at = None, -1
            for i, r in enumerate(near):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del near[at]
            if at < len(near):
                near[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                near[at - 1] = ranks.get(parts[at - 1] + parts[at])
        return [ranks[p] for p in parts]

    def _merge_heap(self, raw: bytes) -> list[int]:
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if not (alive[i] and end[i] == j and j < n and alive[j] and end[j] == stop):
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(raw[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(raw[p:stop])) is not None:
                heapq.heappush(heap, (r, p, i, stop))
        return [ranks[raw[i:end[i]]] for i in range(n) if alive[i]]

    def compatible(self, a: int, b: int) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joint bytes of two encodings."""
        if not left or not right:
            return left + right
        k = 1
        while True:
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[-k:] + right[:k])))
            if ((k >= len(left) or self.compatible(left[-k - 1], window[0]))
                    and (k >= len(right) or self.compatible(window[-1], right[k]))):
                return left[:-k] + window + right[k:]
            k *= 2

    def _tree(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF_BYTES:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join(self._tree(raw[:half]), self._tree(raw[half:]))

    def encode_piece(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        return [whole] if whole is not None else self._tree(raw)

    # -- texts ------------------------------------------------------------

    def _node(self, text: str, start: int, stop: int) -> list[tuple[int, bytes]]:
        """(end, ids) of the pieces of ``text[start:stop]`` taken by itself."""
        if stop - start <= LEAF_CHARS:
            out, cache = [], self.pieces
            for piece in self.scan.findall(text[start:stop]):
                start += len(piece)
                out.append((start, cache[piece]))
            return out
        half = (start + stop) // 2
        return self._join_nodes(text, start, half, stop,
                                self._node(text, start, half), self._node(text, half, stop))

    def _join_nodes(self, text, start, border, stop, left, right):
        while left and left[-1][0] + LOOKAHEAD > border:
            left.pop()
        at = left[-1][0] if left else start
        borders = {border: 0} | {end: i + 1 for i, (end, _) in enumerate(right)}
        reach = 64
        while True:
            limit = min(border + reach, stop)
            pos, middle, met = at, [], borders.get(at)
            for piece in self.scan.findall(text[at:limit]) if met is None else ():
                if pos + len(piece) + LOOKAHEAD > limit < stop:
                    break
                pos += len(piece)
                middle.append((pos, self.pieces[piece]))
                met = borders.get(pos)
                if met is not None:
                    break
            if met is not None:
                left.extend(middle)
                left.extend(right[met:])
                return left
            reach *= 4

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if len(text) <= LEAF_CHARS:
            return b"".join(map(self.pieces.__getitem__, self.scan.findall(text)))
        return b"".join([ids for _, ids in self._node(text, 0, len(text))])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_models: dict[str, ByteBpe] = {}


def _model(key: str, ranks: dict[bytes, int], pattern: str) -> ByteBpe:
    if key not in _models:
        _models.clear()
        _models[key] = ByteBpe(ranks, pattern)
    return _models[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): number of ids, SHA-256 of the
    ids and of the decoded bytes, and the ids themselves on demand.

    The rank file is read on the driver and broadcast (a fixed vocabulary of
    under 1 MB). A null text counts as empty: no ids and the hash of no bytes.
    A null doc_id stays null, repeated rows each give a row, extra columns are
    ignored, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = read_ranks(ranks_path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(key, shared.value, pattern)
        for batch in batches:
            counts, hashes, decoded, sizes, same, kept = [], [], [], [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                ids = model.encode(text)
                raw = model.decode(np.frombuffer(ids, "<u4"))
                counts.append(len(ids) // 4)
                hashes.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(raw).hexdigest())
                sizes.append(len(raw))
                same.append(raw == text.encode())
                if keep_ids:
                    kept.append(ids)
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                       "ids_sha256": pa.array(hashes, pa.string()),
                       "decoded_sha256": pa.array(decoded, pa.string()),
                       "n_bytes": pa.array(sizes, pa.int64()), "round_trip": pa.array(same, pa.bool_())}
            if keep_ids:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return (typed(docs, doc_id="bigint", text="string")
            .mapInArrow(run, OUT_SCHEMA + (", ids binary" if keep_ids else "")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return encode_documents(read_table(spark, sf_dir, "documents"),
                            public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
