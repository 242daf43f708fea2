"""Embedding near-dedup by lattice hashing: E8 cells in several tables, neighbouring
cells probed, cosine verified.

Vectors link when their labels are equal and not null and their cosine, in
double precision, is at least ``threshold``. Vectors that are null, zero or
hold nulls or non-finite components link with nothing, and vectors of unequal
lengths never do.

1. Equal vectors of a label become one node with a count.
2. A table projects the unit vector by random directions and decodes each 8
   coordinates to the nearest E8 point. The node is put into the cell of its
   own points and into the nearest neighbouring cells (of the 240 shortest
   lattice vectors). Cells that hold the same nodes count once.
3. Nodes of a cell are dealt to bounded blocks; each pair of blocks is one
   group, in which a search over verified links emits spanning stars, never
   all pairs. Components come from alternating stars.
4. All links lie within components, so the exact number of links of each node
   is counted there, block against block. A pair that no cell has brought
   together counts too if its component is known.

A link is missed only if no table brings its ends together and no chain of
found links does. For pairs at the threshold in 64 dimensions a table meets
0.67 of them, four tables 0.99; for cosine 0.99 it is over 0.999.

Ties and repeats: rows that share an id or a vector are separate rows that
link. Null labels link with nothing; null ids are never the smallest. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushback.llm.common import group_starts
from pushback.llm.simhash import components
from pushback.session import cut_lineage

THRESHOLD = 0.98
TABLES = 4
#: Lattice points a key is made of, and cells a node is put into, in a table.
POINTS = 2
CELLS = 6
#: Standard deviation of a projected coordinate of a unit vector, in lattice units.
SPREAD = 1.0
SEED = 42
BLOCK_ROWS = 1024
COUNT_ROWS = 4096
#: Rows of one product of vectors.
TILE = 1024


# ---- lattice -----------------------------------------------------------------

@cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, from their rule."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row of 8 numbers."""
    a, b = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _mixed(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hash of rows of small integers."""
    h = start.astype(np.uint64)
    for c in range(values.shape[-1]):
        h = (h ^ values[..., c].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


@cache
def directions(size: int, table: int, points: int, spread: float, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, table, size]).normal(size=(size, 8 * points)) * spread


def cell_keys(unit: np.ndarray, labels: np.ndarray, table: int, *, points: int = POINTS, cells: int = CELLS,
              spread: float = SPREAD, seed: int = SEED) -> np.ndarray:
    """(rows, cells) hashes of (label, table, cell): own cell first, then the
    nearest combinations of neighbouring points."""
    n = len(unit)
    at = unit @ directions(unit.shape[1], table, points, spread, seed)
    salt = np.array([table, unit.shape[1]], dtype=np.int64)
    start = _mixed(np.broadcast_to(salt, (n, 2)), labels.view(np.uint64))
    keys, costs = None, None
    for k in range(points):
        x = at[:, 8 * k:8 * k + 8]
        own = decode(x)
        more = 2 - 2 * ((x - own) @ shortest().T)  # squared distance beyond that of the own point
        near = np.argpartition(more, min(cells, 239), axis=1)[:, :cells]
        options = np.concatenate([own[:, None, :], own[:, None, :] + shortest()[near]], axis=1)
        cost = np.concatenate([np.zeros((n, 1)), np.take_along_axis(more, near, axis=1)], axis=1)
        doubled = np.rint(2 * options).astype(np.int64)
        if keys is None:
            found, total = _mixed(doubled, np.broadcast_to(start[:, None], cost.shape)), cost
        else:
            found = _mixed(np.broadcast_to(doubled[:, None], (n, keys.shape[1], *doubled.shape[1:])),
                           np.broadcast_to(keys[:, :, None], (n, keys.shape[1], cost.shape[1]))).reshape(n, -1)
            total = (costs[:, :, None] + cost[:, None, :]).reshape(n, -1)
        best = np.argsort(total, axis=1, kind="stable")[:, :cells]
        keys, costs = np.take_along_axis(found, best, axis=1), np.take_along_axis(total, best, axis=1)
    return keys.view(np.int64)


# ---- vectors -----------------------------------------------------------------

def _vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of each length in a column of lists without nulls."""
    ends = column.offsets.to_numpy()
    first, sizes = int(ends[0]), np.diff(ends)
    flat = column.values.slice(first, int(ends[-1]) - first).to_numpy(zero_copy_only=False).astype(np.float64)
    out = []
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        out.append((rows, flat[(ends[rows] - first)[:, None] + np.arange(size)]))
    return out


def directed(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by a power of two first, so that no square overflows."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def usable(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == infinite))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v.cast("double") != 0)


def nodes(rows: DataFrame) -> DataFrame:
    """(node, vector, label, n, id) of rows (id, label, vector, node, check):
    equal vectors of a label once.

    Nodes are 64-bit hashes; a second hash finds out if two vectors share one.
    """
    return rows.groupBy("node").agg(
        F.any_value(F.struct("vector", "label")).alias("_one"), F.count(F.lit(1)).alias("n"), F.min("id").alias("id"),
        (F.min("check") != F.max("check")).alias("clash")).select("node", "_one.vector", "_one.label", "n", "id", "clash")


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def cells_of(found: DataFrame, *, tables: int, points: int, cells: int, spread: float, seed: int) -> DataFrame:
    """(key, node) of every cell a node is put into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                node, label = _longs(part.column(0)), _longs(part.column(2))
                for rows, x in _vectors(part.column(1)):
                    unit = directed(x)
                    for t in range(tables):
                        keys = cell_keys(unit, label[rows], t, points=points, cells=cells, spread=spread, seed=seed)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.ravel()), pa.array(np.repeat(node[rows], keys.shape[1]))], names=["key", "node"])

    return found.select("node", "vector", F.xxhash64("label").alias("label")).mapInArrow(run, "key long, node long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each run of equal values of the first column of sorted batches,
    several runs at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        if held and held[-1].column(0)[-1].as_py() != int(keys[0]):
            yield pa.Table.from_batches(held)
            held = []
        last = int(group_starts(keys)[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
    batch = table.combine_chunks().to_batches()[0]
    keys = batch.column(0).to_numpy(zero_copy_only=False)
    starts = group_starts(keys).tolist()
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        if b - a > 1:
            yield batch.slice(a, b - a)


def _stars(unit: np.ndarray, node: np.ndarray, label: np.ndarray, threshold: float) -> tuple[list[int], list[int]]:
    """Spanning stars (member, smallest member) of the links among the rows."""
    order = np.argsort(node)
    unit, node, label = unit[order], node[order], label[order]
    members, roots = [], []
    rest = np.arange(len(node))
    while len(rest) > 1:
        found, queue = [], [rest[0]]
        root, rest = rest[0], rest[1:]
        while queue and len(rest):
            v = queue.pop()
            near = (unit[rest] @ unit[v] >= threshold) & (label[rest] == label[v]) & (node[rest] != node[v])
            if near.any():
                hit = rest[near]
                found.extend(hit.tolist())
                queue.extend(hit.tolist())
                rest = rest[~near]
        members.extend(node[found].tolist())
        roots.extend([int(node[root])] * len(found))
    return members, roots


def links(found: DataFrame, postings: DataFrame, *, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct (u, v), u > v: star edges of verified links in shared cells."""
    shared = postings.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(SEED), "node")).alias("b")).where("n > 1")
    shared = shared.groupBy("n", "a", "b").agg(F.min("key").alias("key")).select("key", "n")
    dealt = (postings.join(shared, "key")
             .select("node", "key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
             .select("node", "key", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("b"))
             .select("node", "key", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select(F.xxhash64("key", F.least("b", "other"), F.greatest("b", "other")).alias("key"), "node"))
    rows = dealt.join(found.select("node", "vector", F.xxhash64("label").alias("label")), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            members, roots = [], []
            for group in _groups(table):
                node, label = _longs(group.column(1)), _longs(group.column(2))
                for at, x in _vectors(group.column(3)):
                    m, r = _stars(directed(x), node[at], label[at], threshold)
                    members += m
                    roots += r
            if members:
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array(roots, pa.int64())],
                                                 names=["u", "v"])

    return (rows.select("key", "node", "label", "vector").repartition("key").sortWithinPartitions("key", "node")
            .mapInArrow(run, "u long, v long").where("u > v").distinct())


def counted(members: DataFrame, *, threshold: float, count_rows: int = COUNT_ROWS) -> DataFrame:
    """(node, links): the copies of other nodes that each node of a component
    (root, node, n, vector) links with.

    A component's nodes are dealt to blocks; each pair of blocks is a group
    and every pair of nodes is in exactly one.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / count_rows).cast("int").alias("blocks"))
    dealt = (members.join(sizes, "root")
             .withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("root", F.least("b", "other"), F.greatest("b", "other")).alias("key"), "root",
                     F.when(F.col("b") == F.col("other"), 0).when(F.col("b") < F.col("other"), 1).otherwise(2).alias("side"),
                     "node", "n", "vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            for group in _groups(table):
                root, side, node, n = (_longs(group.column(c)) for c in range(1, 5))
                for at, x in _vectors(group.column(5)):
                    unit, total = directed(x), np.zeros(len(at), dtype=np.int64)
                    for i in range(0, len(at), TILE):
                        for j in range(0, len(at), TILE):
                            a, b = at[i:i + TILE], at[j:j + TILE]
                            near = unit[i:i + TILE] @ unit[j:j + TILE].T >= threshold
                            near &= (side[a][:, None] == 0) | (side[a][:, None] != side[b])
                            near &= (node[a][:, None] != node[b]) & (root[a][:, None] == root[b])
                            total[i:i + TILE] += near @ n[b]
                    yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(total)], names=["node", "links"])

    return (dealt.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "node long, links long")
            .groupBy("node").agg(F.sum("links").alias("links")))


def near_duplicates(docs: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tables: int = TABLES, points: int = POINTS, cells: int = CELLS,
                    spread: float = SPREAD, seed: int = SEED) -> DataFrame:
    """(id, n_links, component_id) of every row: rows linked directly, and the
    smallest id that links reach, the row's own included."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    apart = ~(usable(F.col("vector")) & F.col("label").isNotNull())
    while True:  # a clash of 64-bit hashes asks for other hashes
        hashed = rows.where(~apart).withColumns({
            "node": F.xxhash64(F.lit(seed), "label", F.size("vector"), "vector"),
            "check": F.xxhash64(F.lit(~seed), "vector", "label")})
        found = cut_lineage(nodes(hashed), "lattice_nodes")
        if not found.where("clash").limit(1).count():
            break
        seed += 1
    postings = cut_lineage(cells_of(found, tables=tables, points=points, cells=cells, spread=spread, seed=seed),
                           "lattice_cells")
    stars = components(links(found, postings, threshold=threshold))
    member = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    member = cut_lineage(member.unionByName(member.select(F.col("root").alias("node"), "root").distinct()), "lattice_members")
    known = found.join(member, "node").select("root", "node", "n", "vector")
    direct = counted(known, threshold=threshold)
    smallest = found.select("node", "id").join(member, "node").groupBy("root").agg(F.min("id").alias("least"))
    result = (found.select("node", "id", "n").join(member, "node", "left").join(smallest, "root", "left")
              .join(direct, "node", "left")
              .select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("least", "id").alias("component_id")))
    result = cut_lineage(result, "lattice_result")
    linked = hashed.select(F.col("id").alias("_id"), "node").join(result, "node")
    alone = rows.where(apart).select(F.col("id").alias("_id"), F.lit(0).cast("bigint").alias("n_links"),
                                     F.col("id").alias("component_id"))
    out = linked.select("_id", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id")
