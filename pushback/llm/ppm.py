"""Prediction by partial matching: byte contexts, escapes, symbol exclusion.

What is modelled is a text's words (A-Z lower-cased) joined by one space and
ended by one end symbol (byte 10, which no such text holds and which also
fills the contexts before its start). The model is a trie of byte contexts of
orders 0 to ORDER with counts over the training texts. A symbol is coded in
the longest context seen; if it is new there, an escape is coded (a symbol
seen c times of T has (c - d) / T, the escape q * d / T for q distinct symbols,
d = DISCOUNT) and the next shorter context is used without the symbols just
excluded; below order 0 the symbols left are alike. Pretrained: scoring does
not change counts.

The trie is never in one place. Texts are dealt to chunks of about
``chunk_bytes``; a chunk's distinct (ORDER + 1)-byte strings with their
training counts go, one row for each shard, to the shard that owns the nearest
three context bytes. A shard so has the whole subtrees below order 2, and
answers each chunk with one number for each string it asked for. Only orders
0 to 2 are shared by all: at most 256^3 counts by the width of a byte. Shards
follow the number of chunks, so that a task holds about four chunks' strings
at any input size; a frequent string is one entry a chunk. The plain word
baseline travels the same way, by 64-bit word hashes.

Larger inputs want larger chunks (``chunk_bytes`` up to what a task may hold):
the strings sent then shrink against the text, and so do the shard rows.

Null and empty texts are the end symbol alone. Without training texts each
byte has 1/256 and the baseline has N = V = 0. Repeated rows are each scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm.common import normal_words
from pushback.session import cut_lineage

ORDER = 5
SHARED_ORDER = 2
DISCOUNT = 0.3
CHUNK_BYTES = 6_000_000
CHUNKS_A_SHARD = 4
LEAST_SHARDS = 32
END = b"\n"
U8 = np.uint64(8)


def mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << (8 * n_bytes)) - 1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed differences."""
    return zlib.compress(np.diff(values, prepend=np.uint64(0)).astype("<u8").tobytes(), 1)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), dtype="<u8"), dtype=np.uint64)


def byte_strings(lines: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct strings, index of each position's string, positions a line):
    the ``order`` bytes before each byte of a line, and the byte."""
    pad = END * order
    data = np.frombuffer(pad + pad.join(lines), dtype=np.uint8)
    keys = np.zeros(len(data) - order, dtype=np.uint64)
    for j in range(order + 1):
        np.left_shift(keys, U8, out=keys)
        np.bitwise_or(keys, data[j:len(data) - order + j], out=keys)
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    own = np.ones(len(keys), dtype=bool)
    ends = np.cumsum(sizes + order) - order
    for j in range(order):
        own[ends[:-1] + j] = False
    codes, distinct = pd.factorize(keys[own])
    return distinct, codes, sizes


def word_hashes(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, index of each token's hash, tokens a text); each text
    ends with the end token."""
    seen: dict[bytes, int] = {}
    codes = [seen.setdefault(w, len(seen)) for words in lists for w in (*words, END)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, seen), dtype=np.uint64, count=len(seen))
    return hashes, np.array(codes, dtype=np.int64), np.array([len(x) + 1 for x in lists], dtype=np.int64)


def shard_of(context3: np.ndarray, shards: int) -> np.ndarray:
    mixed = (context3 + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def in_shards(strings: np.ndarray, hashes: np.ndarray, shards: int) -> Iterator[tuple]:
    """(shard, positions of its strings, of its words), each in sorted order."""
    by_string = shard_of((strings >> U8) & mask(SHARED_ORDER + 1), shards)
    by_word = (hashes % np.uint64(shards)).astype(np.int64)
    s_order, w_order = np.lexsort((strings, by_string)), np.lexsort((hashes, by_word))
    s_cut = np.searchsorted(by_string[s_order], np.arange(shards + 1))
    w_cut = np.searchsorted(by_word[w_order], np.arange(shards + 1))
    for k in range(shards):
        yield k, s_order[s_cut[k]:s_cut[k + 1]], w_order[w_cut[k]:w_cut[k + 1]]


class Level:
    """Counts after the contexts of one order: ``keys`` are context and symbol."""

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray, below: Level | None):
        self.order, self.keys, self.counts = order, keys, counts
        self.contexts, at = np.unique(keys >> U8, return_inverse=True)

        def sums(values: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(at, weights=values, minlength=len(self.contexts)).astype(np.float64)

        self.total, self.kinds = sums(counts), sums()
        #: what this order's symbols count in the next shorter context
        self.covered = sums(below.count(keys)) if below else self.total

    def count(self, strings: np.ndarray) -> np.ndarray:
        return _find(self.keys, strings & mask(self.order + 1), self.counts)


def _find(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of wanted keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def levels(keys: np.ndarray, counts: np.ndarray, orders: Iterable[int], below: list[Level]) -> list[Level]:
    """Levels of the given orders, shortest first, on top of ``below``;
    ``keys`` are strings of any longer order, sorted or not."""
    out = list(below)
    for k in orders:
        short, at = np.unique(keys & mask(k + 1), return_inverse=True)
        out.append(Level(k, short, np.bincount(at, weights=counts, minlength=len(short)), out[-1] if out else None))
    return out


def log_probabilities(strings: np.ndarray, trie: list[Level]) -> np.ndarray:
    """log10 of the chance of each string's last byte after the others."""
    out = np.zeros(len(strings))
    rest = np.arange(len(strings))
    cut_total, cut_kinds = np.zeros(len(strings)), np.zeros(len(strings))
    for level in reversed(trie):
        wanted = strings[rest]
        context = (wanted >> U8) & mask(level.order)
        total, kinds = _find(level.contexts, context, level.total), _find(level.contexts, context, level.kinds)
        left, new = total - cut_total[rest], kinds - cut_kinds[rest]
        count = level.count(wanted)
        use = new > 0
        hit = use & (count > 0)
        out[rest[hit]] += np.log10((count[hit] - DISCOUNT) / left[hit])
        miss = use & ~hit
        out[rest[miss]] += np.log10(new[miss] * DISCOUNT / left[miss])
        # the next shorter context codes without this one's symbols
        cut_total[rest], cut_kinds[rest] = _find(level.contexts, context, level.covered), kinds
        rest = rest[~hit]
    out[rest] -= np.log10(np.maximum(256 - cut_kinds[rest], 1))
    return out


ASKED = T.StructType([
    T.StructField("_chunk", T.LongType()), T.StructField("shard", T.IntegerType()),
    T.StructField("strings", T.BinaryType()), T.StructField("string_counts", T.BinaryType()),
    T.StructField("words", T.BinaryType()), T.StructField("word_counts", T.BinaryType())])
ANSWERS = T.StructType([
    T.StructField("_chunk", T.LongType()), T.StructField("shard", T.IntegerType()),
    T.StructField("chances", T.BinaryType()), T.StructField("word_counts", T.BinaryType()),
    T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
#: Rows of whole sums instead of a chunk's or shard's own.
WHOLE = -1


def _lines(texts: Iterable[bytes | None]) -> tuple[list[list[bytes]], list[bytes]]:
    lists = [normal_words(t) for t in texts]
    return lists, [b" ".join(words) + END for words in lists]


def ask(rows: pd.DataFrame, shards: int) -> pd.DataFrame:
    """A chunk's distinct strings and words with their training counts, a row
    for each shard, and one of the shared orders' counts."""
    lists, lines = _lines(rows["_raw"])
    train = rows["_train"].to_numpy(dtype=bool)
    strings, at, sizes = byte_strings(lines)
    counts = np.bincount(at, weights=np.repeat(train, sizes), minlength=len(strings)).astype("<u4")
    hashes, w_at, w_sizes = word_hashes(lists)
    w_counts = np.bincount(w_at, weights=np.repeat(train, w_sizes), minlength=len(hashes)).astype("<u4")
    chunk = int(rows["_chunk"].iloc[0])
    out = [(chunk, k, pack_sorted(strings[s]), counts[s].tobytes(), pack_sorted(hashes[w]), w_counts[w].tobytes())
           for k, s, w in in_shards(strings, hashes, shards)]
    seen = counts > 0
    short, at = np.unique(strings[seen] & mask(SHARED_ORDER + 1), return_inverse=True)
    n = np.bincount(at, weights=counts[seen], minlength=len(short)).astype("<u4")
    out.append((chunk, WHOLE, pack_sorted(short), n.tobytes(), b"", b""))
    return pd.DataFrame(out, columns=ASKED.names)


def shared_counts(asked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all strings of SHARED_ORDER + 1 bytes: at most 256^3."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])

    def spread(frames):
        for frame in frames:
            for keys, counts in zip(frame["strings"], frame["string_counts"]):
                yield pd.DataFrame({"key": unpack_sorted(keys).astype(np.int64),
                                    "n": np.frombuffer(counts, dtype="<u4").astype(np.int64)})

    rows = (asked.where(F.col("shard") == WHOLE).select("strings", "string_counts").mapInPandas(spread, schema)
            .groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toPandas())
    return rows["key"].to_numpy(dtype=np.uint64), rows["n"].to_numpy(dtype=np.float64)


def answer(rows: pd.DataFrame, shared: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    """Chances and training counts for every chunk's strings and words of one shard."""
    rows = rows.sort_values("_chunk")
    asked = [unpack_sorted(x) for x in rows["strings"]]
    strings, at = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([np.frombuffer(x, dtype="<u4") for x in rows["string_counts"]]),
                         minlength=len(strings))
    trie = levels(*shared, range(SHARED_ORDER + 1), [])
    seen = counts > 0
    trie = levels(strings[seen], counts[seen], range(SHARED_ORDER + 1, ORDER + 1), trie)
    chances = log_probabilities(strings, trie).astype("<f4")[at]
    words = [unpack_sorted(x) for x in rows["words"]]
    kinds, w_at = np.unique(np.concatenate(words), return_inverse=True)
    w_counts = np.bincount(w_at, weights=np.concatenate([np.frombuffer(x, dtype="<u4") for x in rows["word_counts"]]),
                           minlength=len(kinds)).astype("<i8")
    shard = int(rows["shard"].iloc[0])
    out, s, w = [], 0, 0
    for chunk, own, own_words in zip(rows["_chunk"], asked, words):
        out.append((int(chunk), shard, chances[s:s + len(own)].tobytes(),
                    w_counts[w_at[w:w + len(own_words)]].tobytes(), 0, 0))
        s, w = s + len(own), w + len(own_words)
    out.append((WHOLE, shard, b"", b"", int((w_counts > 0).sum()), int(w_counts.sum())))
    return pd.DataFrame(out, columns=ANSWERS.names)


def add_up(rows: pa.Table, answers: pa.Table, id_col: str, shards: int) -> pa.Table:
    """Sums of each text of a chunk."""
    lists, lines = _lines(rows["_raw"].to_pylist())
    strings, at, sizes = byte_strings(lines)
    hashes, w_at, w_sizes = word_hashes(lists)
    chances, counts = np.zeros(len(strings)), np.zeros(len(hashes))
    of_shard = {k: (c, w) for k, c, w in zip(*(answers[c].to_pylist() for c in ("shard", "chances", "word_counts")))}
    for k, s, w in in_shards(strings, hashes, shards):
        own_chances, own_counts = of_shard[k]
        chances[s] = np.frombuffer(own_chances, dtype="<f4")
        counts[w] = np.frombuffer(own_counts, dtype="<i8")
    of_text = np.repeat(np.arange(len(lines)), sizes)
    of_token = np.repeat(np.arange(len(lines)), w_sizes)
    total = lambda owner, values: np.bincount(owner, weights=values, minlength=len(lines))
    return pa.table({
        id_col: rows[id_col], "_train": rows["_train"], "n_bytes": pa.array(sizes), "n_tokens": pa.array(w_sizes),
        "n_known": pa.array(total(of_token, (counts > 0)[w_at]).astype(np.int64)),
        "_known": pa.array(total(of_token, np.log10(counts + 1)[w_at])), "score": pa.array(total(of_text, chances[at]))})


def score_documents(docs: DataFrame, *, train: Column, id_col: str = "doc_id", text_col: str = "text",
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, train, n_bytes, n_tokens, n_known, train_tokens, base_score, score)
    of every text, learned from the rows for which ``train`` holds."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    chunks = max(1, -(-size // chunk_bytes))
    shards = max(LEAST_SHARDS, -(-chunks // CHUNKS_A_SHARD))
    id_type = docs.schema[id_col].dataType
    dealt = docs.select(
        F.col(id_col), F.coalesce(train, F.lit(False)).alias("_train"), F.col(text_col).cast("binary").alias("_raw"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)).alias("_chunk"))
    asked = cut_lineage(dealt.groupBy("_chunk").applyInPandas(lambda rows: ask(rows, shards), ASKED), "strings")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(shared_counts(asked))
    answers = cut_lineage(asked.where(F.col("shard") != WHOLE).groupBy("shard")
                          .applyInPandas(lambda rows: answer(rows, shared.value), ANSWERS), "chances")
    v, n = answers.where(F.col("_chunk") == WHOLE).agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    sums = T.StructType([
        T.StructField(id_col, id_type), T.StructField("_train", T.BooleanType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("_known", T.DoubleType()),
        T.StructField("score", T.DoubleType())])
    scored = (dealt.groupBy("_chunk").cogroup(answers.where(F.col("_chunk") != WHOLE).groupBy("_chunk"))
              .applyInArrow(lambda rows, got: add_up(rows, got, id_col, shards), sums))
    return scored.select(
        id_col, F.col("_train").alias("train"), "n_bytes", "n_tokens", "n_known", F.lit(n).alias("train_tokens"),
        (F.col("_known") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"), "score")
