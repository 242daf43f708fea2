"""Leakage-safe cleaning steps (B6-B10, D15, D14) and the cleaning job (H2)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.functions.exprs import delay_category, is_all_digits
from pushback.operators.quantiles import DEFAULT_ACCURACY, quantile_map


def drop_columns_if_present(df: DataFrame, columns: Sequence[str] = P.LEAKAGE_COLUMNS
                            ) -> DataFrame:
    """Drop post-departure and identifier columns that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def drop_numeric_code_rows(df: DataFrame, origin: str = "ORIGIN_AIRPORT",
                           dest: str = "DESTINATION_AIRPORT") -> DataFrame:
    """Remove rows whose origin or destination is an all-digit id (NULL kept)."""
    numeric = is_all_digits(origin) | is_all_digits(dest)
    return df.filter(~F.coalesce(numeric, F.lit(False)))


def add_target(df: DataFrame, delay: str = "DEPARTURE_DELAY",
               cancelled: str = "CANCELLED", target: str = P.TARGET,
               drop_inputs: bool = True) -> DataFrame:
    """Four-class label; the two source columns are dropped afterwards."""
    out = df.withColumn(target, delay_category(delay, cancelled))
    return out.drop(delay, cancelled) if drop_inputs else out


def drop_null_label(df: DataFrame, target: str = P.TARGET) -> DataFrame:
    """B9."""
    return df.filter(F.col(target).isNotNull())


def capping_bounds(df: DataFrame, columns: Sequence[str] = P.CAPPED_COLUMNS,
                   lower: float = P.CAP_LOWER_Q, upper: float = P.CAP_UPPER_Q,
                   accuracy: int = DEFAULT_ACCURACY) -> dict:
    """Exact lower/upper quantiles of the present columns: ``{col: (lo, hi)}``."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    q = quantile_map(df, present, [lower, upper], accuracy)
    return {c: (q.get((c, round(lower, 12))), q.get((c, round(upper, 12)))) for c in present}


def cap_outliers(df: DataFrame, columns: Sequence[str] = P.CAPPED_COLUMNS,
                 lower: float = P.CAP_LOWER_Q, upper: float = P.CAP_UPPER_Q,
                 bounds: dict | None = None, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Clip listed columns to their exact 1% / 99% quantiles (NULL stays NULL).

    The bounds are one row of statistics, inlined as literals, so the clip is a
    plain projection with no join.
    """
    bounds = bounds if bounds is not None else capping_bounds(df, columns, lower, upper, accuracy)
    out = df
    for c, (lo, hi) in bounds.items():
        if lo is None or hi is None:
            continue
        v = F.col(c).cast("double")
        out = out.withColumn(c, F.when(v.isNull(), v).otherwise(
            F.greatest(F.least(v, F.lit(float(hi))), F.lit(float(lo)))))
    return out


def drop_residual_nulls(df: DataFrame, allowed: Sequence[str] = P.NULLABLE_AFTER_CLEANING
                        ) -> DataFrame:
    """Drop rows with a NULL in any column except the allowed ones."""
    subset = [c for c in df.columns if c not in set(allowed)]
    return df.dropna(how="any", subset=subset)


def missing_cells(df: DataFrame) -> F.Column:
    """Expression: number of NULL cells in a row-set (used inside ``agg``)."""
    terms = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def cleaning_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with rows / columns / missing cells before and after."""
    b = before.agg(F.count(F.lit(1)).alias("rows"), missing_cells(before).alias("missing"))
    a = after.agg(F.count(F.lit(1)).alias("rows"), missing_cells(after).alias("missing"))
    both = (b.withColumn("stage", F.lit("before")).withColumn("columns", F.lit(len(before.columns)))
            .unionByName(a.withColumn("stage", F.lit("after"))
                         .withColumn("columns", F.lit(len(after.columns)))))

    def pick(stage, c):
        return F.sum(F.when(F.col("stage") == stage, F.col(c)))

    return both.agg(
        pick("before", "rows").cast("bigint").alias("rows_before"),
        pick("before", "columns").cast("bigint").alias("columns_before"),
        pick("before", "missing").cast("bigint").alias("missing_cells_before"),
        pick("after", "rows").cast("bigint").alias("rows_after"),
        pick("after", "columns").cast("bigint").alias("columns_after"),
        pick("after", "missing").cast("bigint").alias("missing_cells_after"),
        (pick("before", "rows") - pick("after", "rows")).cast("bigint").alias("rows_dropped"),
        (pick("before", "columns") - pick("after", "columns")).cast("bigint")
        .alias("columns_dropped"),
    )


def clean(df: DataFrame, capped: Sequence[str] = P.CAPPED_COLUMNS,
          accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """H2: the cleaning steps in order; the input DataFrame is not changed.

    Capping needs its bounds from the labelled, filtered rows, so they are
    computed (one small job) on that intermediate plan and inlined.
    """
    staged = (df.transform(drop_columns_if_present)
                .transform(drop_numeric_code_rows)
                .transform(add_target)
                .transform(drop_null_label))
    return (staged.transform(lambda d: cap_outliers(d, capped, accuracy=accuracy))
                  .transform(drop_residual_nulls))
