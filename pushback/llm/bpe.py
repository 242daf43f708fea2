"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern. Tier one: a minimal
perfect hash (hash and displace, built from the rank file) finds pre-tokens
that are vocabulary entries as a whole. Tier two: misses are merged with a
heap of candidate pairs over a linked list of byte spans.

Cutting is sped up without changing it: in a run of text, a pre-token always
starts at a space that a non-space character follows, so a text splits there
first and each such chunk ("word, ") is cut once and remembered in a bounded
table. A text with other white space around a space is cut by the pattern as
a whole. Null texts are empty and have no ids. Special-token strings are
ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm.common import map_rows

#: Entries of a worker's memory, which is emptied when full, and the longest
#: chunk that is remembered: bounds of memory, without effect on results.
MEMORY_ENTRIES = 250_000
MEMORY_CHARS = 48


class PerfectHash:
    """Minimal perfect hash of ``keys`` (distinct bytes): hash and displace.

    A key's 64-bit hash gives its bucket and two numbers (f, g). A bucket's
    displacement d moves its keys to slots (f + (d div n) * g + d) mod n of
    the n = len(keys) slots; large buckets choose theirs first, and buckets of
    one key take the slots that are left.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        self.n = max(1, len(keys))
        self.buckets = self.n // 2 + 1
        self.step = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.n
        self.values = [0] * self.n
        grouped: dict[int, list[tuple[int, int]]] = {}
        for i, k in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(k)
            grouped.setdefault(h % self.buckets, []).append((h, i))
        in_order = sorted(grouped.items(), key=lambda x: -len(x[1]))
        for bucket, members in (x for x in in_order if len(x[1]) > 1):
            d = 0
            while True:
                slots = [self._slot(h, d) for h, _ in members]
                if all(self.keys[s] is None for s in slots) and len(set(slots)) == len(slots):
                    break
                d += 1
            self._place(bucket, d, slots, [i for _, i in members], keys, values)
        free = (s for s, k in enumerate(self.keys) if k is None)
        for bucket, [(h, i)] in (x for x in in_order if len(x[1]) == 1):
            slot = next(free)
            self._place(bucket, (slot - self._slot(h, 0)) % self.n, [slot], [i], keys, values)

    def _place(self, bucket, d, slots, chosen, keys, values) -> None:
        self.step[bucket] = d
        for s, i in zip(slots, chosen):
            self.keys[s], self.values[s] = keys[i], values[i]

    def _slot(self, h: int, d: int) -> int:
        return ((h >> 20) + d // self.n * ((h >> 9) | 1) + d) % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        s = self._slot(h, self.step[h % self.buckets])
        return self.values[s] if self.keys[s] == key else None


class Vocabulary:
    """Ranks of a rank file: token bytes and id on each line, base64."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.whole = PerfectHash(list(self.ranks), list(self.ranks.values()))
        self.tokens = {i: token for token, i in self.ranks.items()}

    def encode_piece(self, piece: bytes) -> list[int]:
        known = self.whole.get(piece)
        return [known] if known is not None else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left.

        Spans are linked by their start: ``end[i]`` is where the span that
        starts at i ends (0: merged away), ``before[i]`` where the one before
        it starts. Heap entries that no longer match the links are skipped.
        """
        n, rank = len(piece), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, left, mid, stop = heappop(heap)
            if end[left] != mid or end[mid] != stop:
                continue
            end[left], end[mid] = stop, 0
            if (first := before[left]) >= 0 and (r := rank(piece[first:stop])) is not None:
                heappush(heap, (r, first, left, stop))
            if stop < n:
                before[stop] = left
                if (r := rank(piece[left:end[stop]])) is not None:
                    heappush(heap, (r, left, stop, end[stop]))
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at:end[at]]])
            at = end[at]
        return ids


class OddSpace(Exception):
    """A chunk that does not start a pre-token."""


class ChunkTable(dict):
    """Bounded memory of chunks: text after a space -> ids as little-endian
    unsigned 32-bit integers."""

    def __init__(self, encode_piece: Callable[[bytes], list[int]], pattern: str):
        super().__init__()
        self.encode_piece = encode_piece
        self.findall = regex.compile(pattern).findall

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0] <= " " or chunk[0].isspace():
            raise OddSpace
        out = self.cut(" " + chunk, chunk)
        if len(chunk) <= MEMORY_CHARS:
            if len(self) >= MEMORY_ENTRIES:
                self.clear()
            self[chunk] = out
        return out

    def cut(self, text: str, word: str) -> bytes:
        pieces = [text] if word.isalpha() else self.findall(text)
        ids = [i for p in pieces for i in self.encode_piece(p.encode())]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            parts = [self.cut(first, first)] if first else []
            if not rest:
                return parts[0] if parts else b""
            if not first or first[-1].isspace() or first[-1] <= " ":
                return self.cut(text, "")
            parts.extend(map(self.__getitem__, rest))
            return b"".join(parts)
        except OddSpace:
            return self.cut(text, "")


class PieceMemory(dict):
    """Bounded memory of merged pre-tokens."""

    def __init__(self, encode_piece: Callable[[bytes], list[int]]):
        super().__init__()
        self.encode_piece = encode_piece

    def __missing__(self, piece: bytes) -> list[int]:
        ids = self.encode_piece(piece)
        if len(piece) <= MEMORY_CHARS:
            if len(self) >= MEMORY_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> ChunkTable:
    return ChunkTable(PieceMemory(vocabulary(path).encode_piece).__getitem__, pattern)


def encode(docs: DataFrame, *, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit integers."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(rows):
        table = encoder(path, pattern)
        for key, text in rows:
            ids = table.encode(text) if text else b""
            yield key, len(ids) // 4, ids

    return map_rows(docs.select(F.col(id_col), F.col(text_col).alias("_text")), run, schema)


def decode(encoded: DataFrame, *, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The input's id, n_tokens and ids, and ``decoded``: the bytes of the ids."""
    schema = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.BinaryType())])

    def run(rows):
        tokens = vocabulary(path).tokens.__getitem__
        for key, n, ids in rows:
            yield key, n, ids, b"".join(map(tokens, np.frombuffer(ids, dtype="<u4").tolist()))

    return map_rows(encoded.select(F.col(id_col), "n_tokens", F.col(ids_col).alias("ids")), run, schema)
