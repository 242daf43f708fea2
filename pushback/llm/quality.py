"""Quality classifier: supervised subword embeddings.

A text's features are its words, the character n-grams of each word (bytes,
with edge marks) and its word pairs, hashed to ``buckets`` learned vectors; a
word's vector is the mean of its own. A pair of equal words hashes by that
relation instead of by the word. The mean over words, pairs and an end mark is
the text's vector; a softmax over it gives the score. Training is stochastic
gradient descent in numpy on a bounded sample of whole labelled texts
(``per_class`` rows a class). Null and empty texts have the end mark alone.

As the output layer is linear, scoring sums each feature's projection on it,
which equals averaging the vectors first.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushback.llm.common import fit_in_task, labelled_sample

PER_CLASS = 1500
BUCKETS = 1 << 16
DIM = 8
GRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 2.0
THRESHOLD = 0.5
#: Text is scored in portions of about so many bytes (a longer text is one).
PORTION_BYTES = 2_000_000
END, SAME = 0, 1  # buckets kept for the end mark and for a word repeated
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and bucket of every word's own hash and character n-grams."""
    data = np.frombuffer(b"<" + b"><".join(words) + b">", dtype=np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    crc = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    index, values = [np.arange(len(words))], [crc << np.uint64(32)]
    for n in GRAMS:
        stop = len(data) - n + 1
        gram = np.full(max(stop, 0), n, dtype=np.uint64)
        for i in range(n):
            gram = (gram << np.uint64(8)) | data[i:stop + i]
        inside = owner[:stop] == owner[n - 1:]
        index.append(owner[:stop][inside])
        values.append(gram[inside])
    mixed = (np.concatenate(values) * MIX) >> np.uint64(24)
    return np.concatenate(index), (mixed % np.uint64(buckets - 2)).astype(np.int64) + 2


def pair_buckets(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of neighbouring words, from their 32-bit hashes."""
    a, b = codes[:-1], codes[1:]
    mixed = (a * MIX + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(24)
    return np.where(a == b, SAME, (mixed % np.uint64(buckets - 2)).astype(np.int64) + 2)


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


def text_features(raw: bytes | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which sum to one."""
    words = raw.split() if raw else []
    ids, weights = [np.array([END])], [np.ones(1)]
    if words:
        index, own = word_features(words, buckets)
        ids.append(own)
        weights.append(1.0 / np.bincount(index)[index])
        pairs = pair_buckets(word_codes(words), buckets)
        ids.append(pairs)
        weights.append(np.ones(len(pairs)))
    total = np.bincount(np.concatenate(ids), weights=np.concatenate(weights))
    kinds = np.flatnonzero(total)
    return kinds, (total[kinds] / total.sum()).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dim
    output: np.ndarray  # dim x 2
    bias: np.ndarray  # 2

    @property
    def buckets(self) -> int:
        return len(self.vectors)


def fit(sample: list[tuple[str, int]], *, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS,
        rate: float = RATE, seed: int = 7) -> Model:
    """Softmax over averaged vectors by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    output, bias = np.zeros((dim, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    rows = [(*text_features(t.encode(), buckets), y) for t, y in sample]
    n_class = np.bincount([y for _, _, y in rows], minlength=2) if rows else np.zeros(2)
    balance = [len(rows) / (2 * n) if n else 0.0 for n in n_class]
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, w, y = rows[i]
            step = rate * (1 - done / steps)
            done += 1
            hidden = w @ vectors[ids]
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            p *= min(balance[y], 4.0) * step
            back = output @ p
            output -= np.outer(hidden, p)
            bias -= 0.05 * p
            # the mean spreads a text's gradient thinly over its features;
            # dividing by the root of the weights' energy evens texts out
            vectors[ids] -= (w / np.sqrt(w @ w))[:, None] * back
    return Model(vectors, output, bias)


class Scorer:
    """A model folded to one number a bucket."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias, self.buckets = table.astype(np.float64), bias, len(table)

    def portion(self, texts: list[bytes]) -> np.ndarray:
        """Scores of some texts; each distinct word is projected once."""
        lists = [t.split() for t in texts]
        counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        total = np.full(len(lists), self.table[END])
        n = 1 + counts + np.maximum(counts - 1, 0)
        if counts.any():
            seen: dict[bytes, int] = {}
            at = np.array([seen.setdefault(w, len(seen)) for words in lists for w in words], dtype=np.int64)
            kinds = list(seen)
            index, buckets = word_features(kinds, self.buckets)
            sums = np.bincount(index, weights=self.table[buckets]) / np.bincount(index)
            codes = word_codes(kinds)[at]
            owner = np.repeat(np.arange(len(lists)), counts)
            total += np.bincount(owner, weights=sums[at], minlength=len(lists))
            same = owner[:-1] == owner[1:]
            pairs = self.table[pair_buckets(codes, self.buckets)][same]
            total += np.bincount(owner[1:][same], weights=pairs, minlength=len(lists))
        return 1 / (1 + np.exp(-np.clip(total / n + self.bias, -50, 50)))

    def scores(self, texts: Iterable[bytes | None]) -> np.ndarray:
        out, held, size = [np.zeros(0)], [], 0
        for t in texts:
            held.append(t or b"")
            size += len(held[-1])
            if size >= PORTION_BYTES:
                out.append(self.portion(held))
                held, size = [], 0
        if held:
            out.append(self.portion(held))
        return np.concatenate(out)


@lru_cache(maxsize=2)
def _loaded(blob: bytes) -> Scorer:
    return Scorer(*pickle.loads(blob))


def scorer(model: Model):
    """Column expression of the score of a text column cast to binary."""
    lean = model.output[:, 1] - model.output[:, 0]
    blob = pickle.dumps(((model.vectors @ lean).astype(np.float32), float(model.bias[1] - model.bias[0])))

    @F.pandas_udf("double")
    def score(raw: pd.Series) -> pd.Series:
        return pd.Series(_loaded(blob).scores(raw), dtype="float64")

    return score


def trained(docs: DataFrame, labels: DataFrame, *, train: Column, per_class: int = PER_CLASS,
            id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model of at most ``per_class`` labelled training texts of each class."""
    return fit_in_task(labelled_sample(docs, labels, label="quality", train=train, per_class=per_class,
                                       id_col=id_col, text_col=text_col), fit)


def score_documents(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    return docs.withColumn(score_col, scorer(model)(F.col(text_col).cast("binary")))
