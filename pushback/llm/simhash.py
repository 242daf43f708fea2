"""SimHash near-dedup: pigeonhole blocks, join on blocks, Hamming check.

A fingerprint takes the majority of each bit of XXH64 (seed 42) over the
4-word shingles of a text with A-Z lower-cased (fewer words: the whole
sequence is one shingle; no word or null: fingerprint 0, linked like others).

Two fingerprints that differ in at most ``max_bits`` bits agree on at least
``agree`` of ``max_bits + agree`` bit blocks, so they share one of the
C(max_bits + agree, agree) masked keys. Equal fingerprints are collapsed
first. Members of a key are dealt to blocks of about ``block_rows``; each
pair of blocks is one bounded group, in which every pair is covered by a
breadth-first search that emits a spanning star, never all pairs. A group's
size is thus bounded, however many copies there are, and no candidate is
dropped. Connected components come from alternating large and small stars,
each round written to the checkpoint folder.

Ties and repeats: equal ids with equal texts form one group. A null id gets
its fingerprint and the component of the other ids it links to.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm.common import free_name, group_starts, map_rows, normal_words
from pushback.session import cut_lineage

SHINGLE_WORDS = 4
MAX_BITS = 4
AGREE_BLOCKS = 2
BLOCK_ROWS = 1024
HASH_SEED = 42


def fingerprint(raw: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as a signed 64-bit integer."""
    words = normal_words(raw)
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        hashes = [digest(line, HASH_SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = [digest(line[s:e - 1], HASH_SEED) for s, e in zip(starts, ends[shingle_words - 1:])]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 4096):
        bits = np.unpackbits(h[at:at + 4096].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, text_hash, fp): one row per document, ``fp`` a signed long."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])

    def run(rows):
        for key, h, raw in rows:
            yield key, h, fingerprint(raw, shingle_words)

    return map_rows(docs.select(F.col(id_col), F.xxhash64(text_col).alias("_h"),
                                F.col(text_col).cast("binary").alias("_raw")), run, schema)


def block_masks(max_bits: int = MAX_BITS, agree: int = AGREE_BLOCKS) -> list[int]:
    """Bit masks of every choice of ``agree`` blocks, as signed longs."""
    n = max_bits + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, agree)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _stars(fps: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Spanning stars (member, smallest member) of the link graph of ``fps``."""
    fps = np.unique(fps)
    members, roots = [], []
    bits = fps.view(np.uint64)
    rest = np.arange(len(fps))
    while len(rest) > 1:
        found, queue = [], [rest[0]]
        root, rest = rest[0], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(bits[rest] ^ bits[queue.pop()]) <= max_bits
            if near.any():
                hit = rest[near]
                found.extend(hit.tolist())
                queue.extend(hit.tolist())
                rest = rest[~near]
        members.extend(fps[found].tolist())
        roots.extend([int(fps[root])] * len(found))
    return members, roots


def block_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Stars of each run of equal keys in batches sorted by (key, fp)."""
    held_k, held_f = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def solve(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = group_starts(keys)
        sizes = np.diff(np.append(starts, len(keys)))
        two = starts[sizes == 2]
        a, b = fps[two], fps[two + 1]
        near = (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= max_bits) & (a != b)
        members, roots = [np.maximum(a, b)[near]], [np.minimum(a, b)[near]]
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            m, r = _stars(fps[s:s + n], max_bits)
            members.append(np.array(m, dtype=np.int64))
            roots.append(np.array(r, dtype=np.int64))
        u, v = np.concatenate(members), np.concatenate(roots)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([held_k, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([held_f, batch.column(1).to_numpy(zero_copy_only=False)])
        last = group_starts(keys)[-1]
        yield from solve(keys[:last], fps[:last])
        held_k, held_f = keys[last:], fps[last:]
    if len(held_k):
        yield from solve(held_k, held_f)


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, agree: int = AGREE_BLOCKS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct (u, v), u > v: star edges that connect exactly the
    fingerprints reachable through links of at most ``max_bits`` bits."""
    masks = block_masks(max_bits, agree)
    keys = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = (keys.join(shared, "key")
             .select("fp", "key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
             .select("fp", "key", "blocks", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("b"))
             .select("fp", "key", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select(F.xxhash64("key", F.least("b", "other"), F.greatest("b", "other")).alias("key"), "fp"))
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
    return (dealt.repartition("key").sortWithinPartitions("key", "fp")
            .mapInArrow(lambda batches: block_links(batches, max_bits), schema).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, with the
    smallest. Alternating stars until nothing changes, at most about the
    square of the logarithm of the nodes in rounds."""
    edges = cut_lineage(edges, "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges
        state = now


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, text_hash, fp, root) of every row; rows of one group share root,
    the smallest fingerprint (as a signed long) of their component."""
    prints = cut_lineage(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words),
                         "fingerprints")
    nodes = prints.select("fp").distinct()
    star = components(links(nodes, max_bits=max_bits)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = nodes.join(star, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints.join(rooted, "fp").select(F.col(id_col), "text_hash", "fp", "root")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id): component_id is the smallest id reachable."""
    found = groups(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, max_bits=max_bits)
    smallest = found.groupBy("root").agg(F.min(id_col).alias("component_id"))
    return found.join(smallest, "root").select(F.col(id_col), "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents with one row kept of each near-duplicate group: the smallest
    id (null last), of rows with that id one of the smallest text hash."""
    found = groups(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, max_bits=max_bits)
    keep = found.groupBy("root").agg(F.min(F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_hash").alias("h"))).alias("k"))
    kept_id, kept_hash = free_name(docs, "_keep_id"), free_name(docs, "_keep_h")
    keep = keep.select(F.col("k.id").alias(kept_id), F.col("k.h").alias(kept_hash))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.xxhash64(text_col) == F.col(kept_hash))
    return (docs.join(keep, same).drop(kept_id)
            .dropDuplicates([id_col, kept_hash]).drop(kept_hash))


def fingerprint_hex(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
