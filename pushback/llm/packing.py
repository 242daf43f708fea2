"""Best-fit decreasing packing of token sequences into fixed windows.

A document's ids (ending with ``end_id``) are cut into full windows and one
remainder. Pieces are dealt by hash to groups of about ``group_rows``, each
packed on its own: pieces in decreasing length go to the open sequence with
the tightest room, found by a segment tree indexed by remaining capacity; a
full window fills a sequence by itself. The number of groups follows the
number of pieces, so a group's size is bounded at any scale.

Null texts are empty: a document of the end id alone. Rows that repeat an id
are packed each. Ties in length go by hash, id and start. An empty table
gives no row.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm.bpe import ChunkTable
from pushback.llm.common import map_rows
from pushback.session import cut_lineage

WINDOW = 2048
END_ID = 1
GROUP_ROWS = 4096


def byte_of_character() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level BPE files: printable
    Latin-1 characters stand for themselves, the others follow U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def json_encoder(path: str) -> ChunkTable:
    """Encoder of a byte-level BPE ``tokenizer.json``.

    Ids follow its order of merges, which for these files is the order of its
    ids, so the merges of each pre-token run in tiktoken's native code; tests
    hold the ids against the tokenizers library.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte = byte_of_character()
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in byte for c in token)}
    core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ChunkTable(core._core_bpe.encode_single_piece, public_tokenizers.PATTERN)


def pieces(docs: DataFrame, *, path: str, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids, doc_tokens): full windows, then the remainder;
    ids are little-endian unsigned 32-bit integers."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(rows):
        table = json_encoder(path)
        for key, text in rows:
            ids = (table.encode(text) if text else b"") + end
            for at in range(0, len(ids), 4 * window):
                part = ids[at:at + 4 * window]
                yield key, at // 4, len(part) // 4, part, len(ids) // 4

    return map_rows(docs.select(F.col(id_col), F.col(text_col).alias("_text")), run, schema, batch_rows=1000)


class Capacities:
    """Segment tree over remaining capacities 0..window: which have an open
    sequence, and the smallest one of at least a given size."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        self._count(capacity, 1)

    def _count(self, capacity: int, by: int) -> None:
        at = capacity + self.size
        while at:
            self.tree[at] += by
            at >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take an open sequence of the smallest capacity >= need."""
        at = need + self.size
        while not self.tree[at]:
            while at & 1:  # a right child: climb to where a right sibling exists
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        capacity = at - self.size
        self._count(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; ``lengths`` must not increase."""
    room, used, sequences, offsets = Capacities(window), 0, [], []
    for n in lengths:
        found = room.tightest(n) if n < window else None
        if found is None:
            found = (window, used)
            used += 1
        capacity, sequence = found
        sequences.append(sequence)
        offsets.append(window - capacity)
        if capacity > n:
            room.add(capacity - n, sequence)
    return sequences, offsets


def pack(parts: DataFrame, *, order: list[str], length_col: str = "length", window: int = WINDOW,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """The rows of ``parts`` with sequence_id and offset. ``order``: columns
    that break ties in length and deal rows to groups."""
    parts = cut_lineage(parts, "pieces")
    groups = max(1, -(-parts.count() // group_rows))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(length_col, "descending"), *((c, "ascending") for c in order)]).drop_columns(["_group"])
        sequences, offsets = best_fit_decreasing(rows[length_col].to_pylist(), window)
        ids = np.array(sequences, dtype=np.int64) * groups + key[0].as_py()
        return rows.append_column("sequence_id", pa.array(ids)).append_column(
            "offset", pa.array(offsets, type=pa.int64()))

    return (parts.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)))
            .groupBy("_group").applyInArrow(run, schema))
