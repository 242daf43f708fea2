"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushback.session import cut_lineage

# Dimension tables (airports, airlines, holidays) hold at most this many rows
# before a broadcast is refused and the join is left to AQE / sort-merge.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
MAX_NARROW_ROWS = 2_000_000  # of tables that the limit in bytes alone may refuse
_WIDTH = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def row_bytes(df: DataFrame) -> int:
    """Rough size of a row: fixed widths, 32 bytes for a key string, 256 for
    anything nested."""
    return sum(_WIDTH.get(t, 8 if t in ("bigint", "double", "timestamp") else 32 if t == "string" else 256)
               for _, t in df.dtypes)


def may_broadcast(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return rows <= max_rows and rows * row_bytes(df) <= MAX_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting the rows (one cheap job on a dimension).

    Beyond the limit the frame is returned unhinted: AQE then measures the
    shuffled size at runtime and picks broadcast or sort-merge itself.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if may_broadcast(df, n, max_rows) else df


def attach_stats(df: DataFrame, stats: DataFrame, keys: list[str], null_safe: bool = False,
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left-join a per-key statistics table back onto the rows.

    The statistics are an aggregate (one row per key, built with map-side
    combining), written once and counted. Under ``max_rows`` they are
    broadcast, so the row table is never shuffled and a hot key costs
    nothing extra; above it the join is a sort-merge join whose skewed
    partitions AQE splits. ``null_safe`` matches NULL keys as one group.
    """
    stats = cut_lineage(stats, "stats")
    small = may_broadcast(stats, stats.count(), max_rows)
    if not null_safe:
        return df.join(F.broadcast(stats) if small else stats, keys, "left")
    renamed = stats.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                           *[c for c in stats.columns if c not in keys])
    renamed = F.broadcast(renamed) if small else renamed
    cond = None
    for k in keys:
        term = df[k].eqNullSafe(renamed[f"__k_{k}"])
        cond = term if cond is None else cond & term
    return df.join(renamed, cond, "left").drop(*[f"__k_{k}" for k in keys])


def keyed_stats(df: DataFrame, keys: list[str], count: str, sums: Sequence[str] = (),
                max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, dict]:
    """Rows (``count``) and sums of columns per value of several single-column keys.

    Rows that agree in all keys are added up first; what is left is unpivoted
    to (key_name, key_value) pairs — NULL values dropped — and grouped once, so
    no row is repeated for each key. The result is written, and the per-key
    value counts decide which slices may be broadcast. Returns (stats, {key:
    broadcastable}).
    """
    whole = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *[F.sum(s).alias(s) for s in sums])
    pairs = (whole.select(*[F.col(k).cast("string").alias(k) for k in keys], count, *sums)
                  .unpivot([count, *sums], keys, "__key", "__value").filter(F.col("__value").isNotNull()))
    stats = cut_lineage(pairs.groupBy("__key", "__value").agg(*[F.sum(c).alias(c) for c in (count, *sums)]),
                        "key_stats")
    sizes = {r["__key"]: r["n"] for r in stats.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).collect()}
    return stats, {k: may_broadcast(stats, sizes.get(k, 0), max_rows) for k in keys}
