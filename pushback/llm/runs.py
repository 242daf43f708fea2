"""Periodic run detection: suffix trees, constant-time LCE, Lyndon roots.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(``min_length``, ``min_repeats`` * q) that no neighbouring word
extends with period q. Each document is handled whole and by itself:

1. Words in no run are cut out. In a run every word occurs at least
   ``min_repeats`` times, so words that are rarer in their stretch split it,
   again and again; this loses no run and shortens none. What remains is one
   sequence in which a unique separator stands for each gap.
2. Ukkonen builds the suffix trees of this sequence and of its reversal. Range
   minima of string depths over an Euler tour answer every longest common
   extension in constant time (block minima in a sparse table, so memory is
   linear).
3. For the order of the words and for its inverse, the longest Lyndon word at
   each position reaches to the next smaller suffix. By the runs theorem these
   are the roots of all runs. Each is extended in both directions by one
   extension forwards and one backwards.

Nulls and texts without words have no run and an empty collapsed text. Rows
that share an id or a text are separate rows with results of their own; other
columns are not read. Ties: runs are ordered by start, then period.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm.common import map_rows

MIN_LENGTH = 6
MIN_REPEATS = 4
#: Cutting out may stop early: fewer words cut cost time only.
CUT_ROUNDS = 16
RMQ_BLOCK = 32

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])


class SuffixTree:
    """Ukkonen's suffix tree of a list of symbols whose last one is unique.

    Nodes are numbers; 0 is the root. ``first`` and ``last`` bound the label of
    the edge into a node, ``parent`` is the node above. ``leaf`` has the leaf
    of each suffix.
    """

    def __init__(self, symbols: list[int]):
        s, n, width = symbols, len(symbols), max(symbols) + 1
        first, last, parent, link, leaf = [0], [0], [0], [0], []
        child: dict[int, int] = {}
        node = edge = length = rest = 0
        for i, c in enumerate(s):
            rest += 1
            fresh = 0
            while rest:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(first)
                    leaf.append(len(first))
                    first.append(i)
                    last.append(n)
                    parent.append(node)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    at = first[below]
                    size = (last[below] if last[below] <= i else i + 1) - at
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if s[at + length] == c:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    cut = len(first)
                    child[key] = cut
                    first.append(at)
                    last.append(at + length)
                    parent.append(node)
                    link.append(0)
                    child[cut * width + c] = cut + 1
                    leaf.append(cut + 1)
                    first.append(i)
                    last.append(n)
                    parent.append(cut)
                    link.append(0)
                    first[below] = at + length
                    child[cut * width + s[at + length]] = below
                    parent[below] = cut
                    if fresh:
                        link[fresh] = cut
                    fresh = cut
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.first, self.last = np.array(first), np.array(last)
        self.parent, self.leaf = np.array(parent), np.array(leaf)
        self.initial = np.array(s)[self.first]
        self.initial[0] = -1

    def children(self, order: np.ndarray) -> tuple[list[int], list[int]]:
        """Nodes by parent, then by ``order`` of the first symbol, and where
        each node's children begin in that list."""
        by = np.lexsort((order, self.parent))
        by = by[by != 0]
        return by.tolist(), np.searchsorted(self.parent[by], np.arange(len(self.first) + 1)).tolist()

    def suffix_ranks(self, order: np.ndarray) -> list[int]:
        """Rank of each suffix when symbols compare by ``order``."""
        below, begin = self.children(order)
        seen, todo = [], [0]
        while todo:
            v = todo.pop()
            a, b = begin[v], begin[v + 1]
            if a == b:
                seen.append(v)
            else:
                todo.extend(below[a:b][::-1])
        rank = np.zeros(len(self.first), dtype=np.int64)
        rank[seen] = np.arange(len(seen))
        return rank[self.leaf].tolist()

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """String depths along an Euler tour, and where each suffix's leaf stands in it."""
        below, begin = self.children(self.initial)
        size, above = (self.last - self.first).tolist(), self.parent.tolist()
        depth, place, depths, todo = [0] * len(size), [0] * len(size), [], [0]
        while todo:
            v = todo.pop()
            if v < 0:  # back from a child
                depths.append(depth[~v])
                continue
            if v:
                depth[v] = depth[above[v]] + size[v]
            place[v] = len(depths)
            depths.append(depth[v])
            for c in below[begin[v]:begin[v + 1]]:
                todo.append(~v)
                todo.append(c)
        return np.array(depths), np.array(place)[self.leaf]


class Extensions:
    """Longest common extensions of suffixes, in constant time each."""

    def __init__(self, symbols: list[int]):
        self.tree = SuffixTree(symbols)
        depths, self.place = self.tree.tour()
        far = int(depths.max()) + 1
        blocks = -(-len(depths) // RMQ_BLOCK)
        grid = np.full(blocks * RMQ_BLOCK, far, dtype=np.int64)
        grid[:len(depths)] = depths
        self.values = grid
        grid = grid.reshape(blocks, RMQ_BLOCK)
        self.up_to = np.minimum.accumulate(grid, axis=1).ravel()
        self.since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [grid.min(axis=1)]
        while 2 << (len(self.table) - 1) <= blocks:
            row, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(row[:-half], row[half:]))

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j (i != j)."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        ka, kb = a // RMQ_BLOCK, b // RMQ_BLOCK
        out = np.minimum(self.since[a], self.up_to[b])
        one = np.flatnonzero(ka == kb)
        if len(one):
            cells = a[one, None] + np.arange(RMQ_BLOCK)
            inside = cells <= b[one, None]
            out[one] = np.where(inside, self.values[np.where(inside, cells, a[one, None])],
                                self.values[a[one], None]).min(axis=1)
        wide = np.flatnonzero(kb - ka > 1)
        if len(wide):
            low, span = ka[wide] + 1, kb[wide] - ka[wide] - 1
            level = np.frexp(span)[1] - 1
            for k in np.unique(level).tolist():
                at = level == k
                row, lo, hi = self.table[k], low[at], low[at] + span[at] - (1 << k)
                out[wide[at]] = np.minimum(out[wide[at]], np.minimum(row[lo], row[hi]))
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each suffix the start of the next smaller one (the last has none: its end)."""
    n = len(rank)
    out, stack = [0] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] if stack else n
        stack.append(i)
    return np.array(out)


def sequence_runs(symbols: list[int], min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
                  ) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of positive symbols."""
    n = len(symbols)
    if n < max(min_length, min_repeats):
        return []
    s = np.array(symbols)
    ahead = Extensions([*symbols, 0])
    behind = Extensions([*symbols[::-1], 0])
    tree = ahead.tree
    starts, periods = [], []
    for order in (tree.initial, np.where(tree.initial == 0, -1, s.max() + 1 - tree.initial)):  # the end comes first
        reach = next_smaller(tree.suffix_ranks(order))[:n]
        i = np.arange(n)
        p = np.minimum(reach, n) - i
        if min_repeats > 2:  # then some root of a run is followed by itself
            twice = i + 2 * p <= n
            i, p = i[twice], p[twice]
            same = (s[i] == s[i + p]) & (s[i + p - 1] == s[i + 2 * p - 1])
            i, p = i[same], p[same]
        starts.append(i)
        periods.append(p)
    i, p = np.concatenate(starts), np.concatenate(periods)
    if not len(i):
        return []
    right = ahead.between(i, i + p)
    left = np.zeros(len(i), dtype=np.int64)
    inner = np.flatnonzero(i > 0)
    if len(inner):
        left[inner] = behind.between(n - i[inner], n - i[inner] - p[inner])
    begin, size = i - left, left + p + right
    long = size >= np.maximum(min_length, min_repeats * p)
    found = np.unique(np.stack([begin[long], p[long], size[long]], axis=1), axis=0)
    return [(b, m, q) for b, q, m in found.tolist()]


def repeating(words: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """Positions that may lie in a run: each word is at least ``min_repeats``
    times in its stretch of remaining neighbours."""
    at = np.flatnonzero(np.bincount(words)[words] >= min_repeats) if len(words) else np.zeros(0, dtype=np.int64)
    width = int(words.max()) + 1 if len(words) else 1
    for _ in range(CUT_ROUNDS):
        if len(at) < min_length:
            return at[:0]
        stretch = np.cumsum(np.diff(at, prepend=at[0] - 1) != 1)
        stays = np.bincount(stretch)[stretch] >= min_length
        if not stays.all():
            at, stretch = at[stays], stretch[stays]
        _, which, count = np.unique(stretch * width + words[at], return_inverse=True, return_counts=True)
        often = count[which] >= min_repeats
        if stays.all() and often.all():
            break
        at = at[often]
    return at


def text_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
              ) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text's words, by start, then period."""
    if len(words) < max(min_length, min_repeats):
        return []
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words])
    at = repeating(ids, min_length, min_repeats)
    if not len(at):
        return []
    _, symbols = np.unique(ids[at], return_inverse=True)
    symbols = symbols + 1
    gaps = np.flatnonzero(np.diff(at) != 1) + 1  # a unique separator for each gap
    symbols = np.insert(symbols, gaps, int(symbols.max()) + 1 + np.arange(len(gaps)))
    place = np.insert(at, gaps, -1)
    return [(int(place[b]), m, q) for b, m, q in sequence_runs(symbols.tolist(), min_length, min_repeats)]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words but those that a run has after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: all runs by start, then
    period, and the text in which each run keeps its first period only, words
    joined by one space."""
    if min_repeats < 2 or min_length < 1:
        raise ValueError("a run repeats its period at least twice and has a word")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.BinaryType())])

    def run(rows):
        for key, raw in rows:
            words = raw.split() if raw else []
            runs = text_runs(words, min_length, min_repeats)
            yield (key, len(words), [{"start": b, "length": m, "period": q} for b, m, q in runs],
                   b" ".join(kept_words(words, runs)))

    found = map_rows(docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("_raw")), run, schema, 200)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest(runs: str):
    """The longest of an array of runs (ties: smallest start, then period); null if none."""
    return F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
