"""Encoding of a whole corpus with a public byte-level BPE tokenizer, from its rank file.

A text is cut by the vocabulary's pattern; each piece is merged on a contiguous array of part boundaries with the rank
of every adjacent pair: find the least rank, delete the boundary, refresh the two ranks beside it, until no pair has a
rank. Pieces of ``LONG`` bytes and more use a heap instead of the scan, so that no text costs its square.

Null and empty texts have no ids. No text is cut or skipped.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabularies, unless the caller or RODADO_TOKENIZERS names another.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that cuts text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 128
#: Pieces a task remembers; beyond that it forgets all and goes on.
REMEMBER = 500_000
_NEVER = 1 << 60


def vocabulary(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    """Path of a rank file; every executor must have it at the same place."""
    return os.path.join(folder or os.environ.get("RODADO_TOKENIZERS", TOKENIZERS), f"{name}.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece, by scans of a contiguous array of ranks."""
    bounds = list(range(len(piece) + 1))
    rank = [ranks.get(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
    while rank:
        low = min(rank)
        if low == _NEVER:
            break
        i = rank.index(low)
        del bounds[i + 1], rank[i]
        if i < len(rank):
            rank[i] = ranks.get(piece[bounds[i] : bounds[i + 2]], _NEVER)
        if i:
            rank[i - 1] = ranks.get(piece[bounds[i - 1] : bounds[i + 1]], _NEVER)
    return [ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids by a heap over linked boundaries: n log n for a piece of n bytes."""
    n = len(piece)
    after, before = list(range(1, n + 2)), list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1") * (n + 1)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end:
            continue
        gone = after[i]
        alive[gone] = 0
        after[i] = end
        before[end] = i
        if end < n and (r := ranks.get(piece[i : after[end]])) is not None:
            heapq.heappush(heap, (r, i, after[end]))
        if i and (r := ranks.get(piece[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Encoder(dict):
    """Text to ids. Itself the memory of pieces met before: most of a corpus are pieces met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import regex

        self.ranks, self.cut = ranks, regex.compile(pattern).findall

    def __missing__(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        one = self.ranks.get(raw)
        ids = [one] if one is not None else (merge_short if len(raw) < LONG else merge_long)(raw, self.ranks)
        if len(raw) < LONG:
            if len(self) >= REMEMBER:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.cut(text)))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, map(self.__getitem__, self.cut(text)))) if text else 0


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a rank file, once for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(load_ranks(path))
    return _encoders[path]


def _text_first(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocab: str | None = None, out: str = "ids") -> DataFrame:
    """(key, ids array<int>): every row of ``docs`` once, repeated keys as often as they are given.

    One pass over the scan's own partitions, no shuffle; other columns are not read.
    """
    path = vocab or vocabulary()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc = encoder(path)
        for b in batches:
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            ends = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in ids], out=ends[1:])
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [key, out])

    kind = docs.schema[key].dataType.simpleString()
    return _text_first(docs, key, text).mapInArrow(run, f"`{key}` {kind}, `{out}` array<int>")


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", vocab: str | None = None, out: str = "n_tokens") -> DataFrame:
    """(key, n_tokens int), as :func:`encode_corpus` without the ids."""
    path = vocab or vocabulary()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(path)
        for b in batches:
            n = [enc.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], [key, out])

    kind = docs.schema[key].dataType.simpleString()
    return _text_first(docs, key, text).mapInArrow(run, f"`{key}` {kind}, `{out}` int")
