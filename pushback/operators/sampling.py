"""Exact stratified sampling, splitting and folds.

All three need each row's rank inside its stratum under a seeded random
order. A window over a whole stratum would put a stratum holding a third of
the table into one task, so the rank is built in two levels: rows are
ordered by ``md5(row_id | seed | salt)``; its first hex digits name a bucket.
Bucket sizes per stratum are an aggregate (at most 16**digits rows per
stratum); a running sum over them gives each bucket's offset, and a window
over (stratum, bucket) — about n / 16**digits rows — ranks rows inside the
bucket. offset + rank is the exact rank in the stratum.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.operators.joins import attach_stats
from pushback.session import cut_lineage

BUCKET_DIGITS = 4


def order_key(row_id: str, seed: int, salt: str) -> Column:
    return F.md5(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed)), F.lit(salt)))


def rank_in_strata(df: DataFrame, strata: Sequence[str], row_id: str = "row_id",
                   seed: int = P.RANDOM_STATE, salt: str = "", rank_col: str = "__rank",
                   size_col: str = "__stratum_n", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Adds the 1-based rank of each row in its stratum and the stratum size.

    NULL strata values form their own stratum.
    """
    strata = list(strata)
    keyed = (df.withColumn("__h", order_key(row_id, seed, salt))
               .withColumn("__b", F.substring("__h", 1, digits)))
    sizes = keyed.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__bn"))
    w = Window.partitionBy(*strata).orderBy("__b")
    offsets = (sizes.withColumn("__off", F.coalesce(F.sum("__bn").over(
                   w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                    .withColumn(size_col, F.sum("__bn").over(Window.partitionBy(*strata)))
                    .drop("__bn"))
    inner = Window.partitionBy(*strata, "__b").orderBy("__h", row_id)
    ranked = keyed.withColumn("__r", F.row_number().over(inner))
    out = attach_stats(ranked, offsets, strata + ["__b"], null_safe=True)
    return (out.withColumn(rank_col, F.col("__off") + F.col("__r"))
               .drop("__h", "__b", "__r", "__off"))


def first_in_strata(df: DataFrame, strata: Sequence[str], take: Column, salt: str, flag: str,
                    row_id: str = "row_id", seed: int = P.RANDOM_STATE, digits: int = BUCKET_DIGITS,
                    only: bool = False) -> DataFrame:
    """Flags the first ``take`` rows of each stratum in the seeded order;
    ``take`` is an expression over ``__stratum_n``, the stratum's size. With
    ``only`` the rest is dropped: the rows up to the cut are written, so that
    ``df`` is not worked out again for the rows at the cut.

    Order by hash is order by bucket, so bucket sizes give a cut-off bucket
    for each stratum: rows before it are in, rows after it are out, and only
    its own rows (about n / 16**digits) are ranked. Other rows are not moved.
    """
    strata = list(strata)
    keyed = (df.withColumn("__h", order_key(row_id, seed, salt))
               .withColumn("__b", F.substring("__h", 1, digits)))
    sizes = keyed.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__bn"))
    run = Window.partitionBy(*strata).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (sizes.withColumn("__off", F.coalesce(F.sum("__bn").over(run), F.lit(0)))
            .withColumn("__stratum_n", F.sum("__bn").over(Window.partitionBy(*strata)))
            .withColumn("__take", take.cast("bigint"))
            .filter(F.col("__off") + F.col("__bn") > F.col("__take")).groupBy(*strata)
            .agg(F.min("__b").alias("__cut"), F.min(F.struct("__b", F.col("__take") - F.col("__off"))).alias("__x"))
            .select(*strata, "__cut", F.col("__x.col2").alias("__need")))
    cuts = cut_lineage(cuts, "cuts")
    placed = attach_stats(keyed, cuts, strata, null_safe=True)
    if only:
        placed = cut_lineage(placed.filter(F.col("__cut").isNull() | (F.col("__b") <= F.col("__cut"))), "taken")
    # a stratum taken whole has no cut
    clear = (placed.filter(F.col("__cut").isNull() | (F.col("__b") != F.col("__cut")))
             .withColumn(flag, F.col("__cut").isNull() | (F.col("__b") < F.col("__cut"))))
    inner = Window.partitionBy(*strata).orderBy("__h", row_id)
    edge = (placed.filter(F.col("__b") == F.col("__cut"))
            .withColumn(flag, F.row_number().over(inner) <= F.col("__need")))
    out = clear.unionByName(edge).drop("__h", "__b", "__cut", "__need")
    return out.filter(flag).drop(flag) if only else out


def stratified_sample(df: DataFrame, strata: Sequence[str] = ("MONTH",),
                      fraction: float = P.SAMPLE_FRACTION, seed: int = P.RANDOM_STATE,
                      row_id: str = "row_id") -> DataFrame:
    """E5: per stratum exactly round_half_even(fraction * n) rows."""
    take = F.bround(F.col("__stratum_n") * F.lit(fraction), 0)
    return first_in_strata(df, strata, take, "sample", "__in", row_id, seed, only=True)


def split_flags(df: DataFrame, label: str = P.TARGET, test_size: float = P.TEST_SIZE,
                seed: int = P.RANDOM_STATE, row_id: str = "row_id",
                flag: str = "is_test") -> DataFrame:
    """Per class clip(round(n * size), 1, n - 1) test rows; a class of <= 1 row is
    all train. NULL labels form a class."""
    n = F.col("__stratum_n")
    k = F.greatest(F.lit(1), F.least(F.bround(n * F.lit(test_size), 0), n - 1))
    return first_in_strata(df, [label], F.when(n > 1, k).otherwise(0), "split", flag, row_id, seed)


def split_table(df: DataFrame, label: str = P.TARGET, test_size: float = P.TEST_SIZE,
                seed: int = P.RANDOM_STATE, row_id: str = "row_id") -> DataFrame:
    """``df`` with the flag ``is_test``, checkpointed (shared folder) so both halves
    read one materialised ranking instead of recomputing it."""
    return cut_lineage(split_flags(df, label, test_size, seed, row_id), "split")


def halves(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a flagged table."""
    return (flagged.filter(~F.col("is_test")).drop("is_test"),
            flagged.filter(F.col("is_test")).drop("is_test"))


def split_dataset(df: DataFrame, label: str = P.TARGET, test_size: float = P.TEST_SIZE,
                  seed: int = P.RANDOM_STATE, row_id: str = "row_id"
                  ) -> tuple[DataFrame, DataFrame]:
    """(train, test) DataFrames sharing ``row_id``."""
    return halves(split_table(df, label, test_size, seed, row_id))


def n_folds(n_rows: int, n_classes: int) -> int:
    """Fold count between 2 and 5: n // max(classes, 2), clamped."""
    return max(2, min(5, n_rows // max(n_classes, 2)))


def assign_folds(df: DataFrame, label: str = P.TARGET, k: int | None = None,
                 seed: int = P.RANDOM_STATE, row_id: str = "row_id",
                 fold_col: str = "fold") -> DataFrame:
    """Stratified folds, fold = (rank in class - 1) % k."""
    if k is None:
        stats = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(label).alias("c")).first()
        k = n_folds(stats["n"], stats["c"])
    ranked = rank_in_strata(df, [label], row_id, seed, "fold")
    return (ranked.withColumn(fold_col, ((F.col("__rank") - 1) % k).cast("int"))
                  .drop("__rank", "__stratum_n"))


def shuffled(df: DataFrame, seed: int = P.RANDOM_STATE, row_id: str = "row_id") -> DataFrame:
    """a seeded order (only for outputs that are read in order)."""
    return df.orderBy(order_key(row_id, seed, "shuffle"))
