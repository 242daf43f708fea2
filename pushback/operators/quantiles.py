"""Exact, distributed quantiles (linear interpolation, as numpy/pandas default).

``F.percentile`` is exact but keeps every distinct value of a group in one
task. Here the wanted order statistics are found digit by digit: a double's bits,
turned so that they sort as the value does, are four digits of 16 bits. One scan
counts the rows of each first digit by group and column; the digit in which a
wanted rank falls is known from running sums, and the next scan counts the next
digit of the rows that begin with it. Once few rows (``accuracy`` or fewer) begin
with the wanted digits, one scan counts their values whole.

A scan reads the columns in Arrow batches, without a row for each cell, and a
task sends counts of digits only: what is shuffled follows the columns, groups
and probabilities, not the rows. The driver holds the wanted digits, two for
each value of the result.
"""

from __future__ import annotations

import math
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.session import cut_lineage

DEFAULT_ACCURACY = 100_000
#: Bits of a digit.
DIGIT = 16
#: Digits that a task holds before it counts and sends them.
HELD = 4_000_000


def _sortable(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles (both zeros are one)."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-2 ** 63)).view(np.uint64)


def _double(code: int) -> float:
    bits = code ^ (1 << 63) if code >> 63 else ~code & (2 ** 64 - 1)
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def _counter(n_groups: int, prefixes: dict | None, left: int, bits: int):
    """Arrow function: (group..., ci, pre, digit, c) of the ``bits`` that follow the
    wanted ``prefixes`` (by group and column; None: of all rows), ``left`` after them."""
    dtype = np.uint16 if bits == DIGIT else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        types: list = []

        def flush() -> pa.RecordBatch:
            slots, digits, counts = [], [], []
            for slot, parts in held.items():
                d, c = np.unique(np.concatenate(parts), return_counts=True)
                slots.append((slot, len(d)))
                digits.append(d.astype(np.int64))
                counts.append(c.astype(np.int64))
            spread = lambda pick, kind: pa.array([pick(s) for s, n in slots for _ in range(n)], type=kind)
            return pa.RecordBatch.from_arrays(
                [*(spread(lambda s, j=j: s[0][j], types[j]) for j in range(n_groups)),
                 spread(lambda s: s[1], pa.int32()), spread(lambda s: s[2], pa.int64()),
                 pa.array(np.concatenate(digits)), pa.array(np.concatenate(counts))],
                names=[*(f"g{j}" for j in range(n_groups)), "ci", "pre", "digit", "c"])

        for batch in batches:
            types = [f.type for f in batch.schema][:n_groups]
            for group, rows in _groups(batch, n_groups):
                for ci in range(batch.num_columns - n_groups):
                    wanted = [0] if prefixes is None else prefixes.get((group, ci), ())
                    if not wanted:
                        continue
                    x = batch.column(n_groups + ci).to_numpy(zero_copy_only=False)
                    x = x if rows is None else x[rows]
                    code = _sortable(x[~np.isnan(x)])
                    head = code >> np.uint64(left + bits) if left + bits < 64 else None
                    for p in wanted:
                        own = code if head is None else code[head == np.uint64(p)]
                        if len(own):
                            digit = (own >> np.uint64(left)) & np.uint64((1 << bits) - 1)
                            held.setdefault((group, ci, p), []).append(digit.astype(dtype))
                            size += len(own)
                if size >= HELD:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return run


def _groups(batch: pa.RecordBatch, n: int) -> list:
    """(group, row numbers) of a batch's first ``n`` columns; None: all rows."""
    if n == 0:
        return [((), None)]
    code = np.zeros(batch.num_rows, dtype=np.int64)
    for j in range(n):
        index = batch.column(j).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = np.unique(code * (index.max(initial=0) + 1) + index, return_inverse=True)[1]
    _, first = np.unique(code, return_index=True)
    return [(tuple(batch.column(j)[int(i)].as_py() for j in range(n)), np.flatnonzero(code == code[i])) for i in first]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), accuracy: int = DEFAULT_ACCURACY
                    ) -> DataFrame:
    """Long table (group..., column, prob, value, n) of exact linear quantiles.

    Null and NaN values do not count, nor do rows with a null group. ``accuracy`` is
    the number of rows that are put in order at once; it does not change the result.
    """
    spark, columns, k = df.sparkSession, list(columns), len(group_cols)
    probs = [float(p) for p in probs]
    keys = [f"g{j}" for j in range(k)]
    key_fields = [T.StructField(g, df.schema[c].dataType) for g, c in zip(keys, group_cols)]
    out_schema = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in group_cols),
                               T.StructField("column", T.StringType()), T.StructField("prob", T.DoubleType()),
                               T.StructField("value", T.DoubleType()), T.StructField("n", T.LongType())])
    rows = df.select(*[F.col(c).alias(g) for g, c in zip(keys, group_cols)],
                     *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    for g in keys:
        rows = rows.filter(F.col(g).isNotNull())
    digits = T.StructType([*key_fields, T.StructField("ci", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("pre", "digit", "c"))])
    wanted_schema = T.StructType([*key_fields, T.StructField("ci", T.IntegerType()),
                                  *(T.StructField(c, T.LongType()) for c in ("pre", "rank"))])
    slot = [*keys, "ci", "pre"]

    def count(prefixes: dict | None, left: int, bits: int) -> DataFrame:
        return (rows.mapInArrow(_counter(k, prefixes, left, bits), digits)
                .groupBy(*slot, "digit").agg(F.sum("c").alias("c")))

    def locate(counts: DataFrame, wanted: set) -> dict:
        """(group, column, prefix, rank) -> digit, rows before it, rows of it."""
        run = Window.partitionBy(*slot).orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        ranks = spark.createDataFrame([(*g, *rest) for g, *rest in wanted], wanted_schema)
        hit = (counts.withColumn("off", F.coalesce(F.sum("c").over(run), F.lit(0)))
               .join(F.broadcast(ranks), slot).filter("off <= rank and rank < off + c"))
        return {(tuple(r[:k]), r["ci"], r["pre"], r["rank"]): (r["digit"], r["off"], r["c"]) for r in hit.collect()}

    left = 64 - DIGIT
    counts = cut_lineage(count(None, left, DIGIT), "quantile_digits")
    sizes = {(tuple(r[:k]), r["ci"]): r["n"]
             for r in counts.groupBy(*keys, "ci").agg(F.sum("c").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], out_schema)
    place = lambda n, p: p * (n - 1)
    # (group, column, rank among all) -> prefix, rank among the rows that begin with it
    at = {(g, ci, r): (0, r) for (g, ci), n in sizes.items() for p in probs
          for r in (math.floor(place(n, p)), math.ceil(place(n, p)))}
    bits = DIGIT
    while True:
        found = locate(counts, {(g, ci, pre, r) for (g, ci, _), (pre, r) in at.items()})
        begun: dict = {}
        for key, (pre, r) in at.items():
            g, ci, _ = key
            digit, off, c = found[g, ci, pre, r]
            at[key] = (pre << bits | digit, r - off)
            begun[g, ci, at[key][0]] = c
        if left == 0:
            break
        bits = left if sum(begun.values()) <= accuracy else DIGIT
        left -= bits
        prefixes: dict = {}
        for g, ci, pre in begun:
            prefixes.setdefault((g, ci), []).append(pre)
        counts = count(prefixes, left, bits)
    out = []
    for (g, ci), n in sizes.items():
        for p in probs:
            h = place(n, p)
            lo, hi = (_double(at[g, ci, r][0]) for r in (math.floor(h), math.ceil(h)))
            out.append((*g, columns[ci], p, lo if lo == hi else lo + (hi - lo) * (h - math.floor(h)), n))
    return spark.createDataFrame(out, out_schema)


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                 accuracy: int = DEFAULT_ACCURACY) -> dict:
    """``{(column, prob): value}`` for ungrouped quantiles (bounded: columns x probs)."""
    rows = exact_quantiles(df, columns, probs, accuracy=accuracy).collect()
    return {(r["column"], round(r["prob"], 12)): r["value"] for r in rows}
