"""Exploration tables behind the notebooks' plots."""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.functions.exprs import label_ordinal
from pushback.operators.quantiles import DEFAULT_ACCURACY, exact_quantiles, quantile_map

#: Sums over rows that have both columns.
SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def class_distribution(df: DataFrame, target: str = P.TARGET,
                       order: Sequence[str] = P.CLASS_ORDER) -> DataFrame:
    """Count and percent of each class, in the fixed class order."""
    counts = df.groupBy(target).count()
    total = F.sum("count").over(Window.partitionBy())  # over <= len(order)+1 rows
    return (counts.select(
        F.col(target).alias("label"),
        label_ordinal(F.col(target), list(order)).alias("class_order"),
        F.col("count").alias("n"),
        F.round(F.col("count") * 100.0 / total, 2).alias("pct")))


def class_share_by(df: DataFrame, by: str, target: str = P.TARGET,
                   order: Sequence[str] = P.CLASS_ORDER,
                   baseline: str = "on_time") -> DataFrame:
    """Share of every class within each value of ``by`` and 1 - on_time share."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg((F.col(target) == c).cast("double")).alias(f"{c}_share") for c in order]
    out = df.groupBy(by).agg(*aggs)
    return out.withColumn("not_on_time_share", 1 - F.col(f"{baseline}_share"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """the ``n`` most frequent non-null values (ties broken by value)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(n)


def normalized_crosstab(df: DataFrame, column: str, top_n: int = 12,
                        target: str = P.TARGET, order: Sequence[str] = P.CLASS_ORDER
                        ) -> DataFrame:
    """D20 + C7: class shares of the top-N groups, long form (group, label, proportion).

    The top-N list is a bounded (N-row) table, so the membership filter is a
    broadcast left-semi join.
    """
    top = F.broadcast(top_values(df, column, top_n).select(column))
    subset = df.join(top, column, "left_semi")
    wide = subset.groupBy(column).pivot(target, list(order)).count().na.fill(0, list(order))
    total = sum((F.col(c) for c in order), F.lit(0))
    shares = wide.select(F.col(column).cast("string").alias("segment"),
                         *[(F.col(c) / total).alias(c) for c in order])
    return shares.unpivot("segment", list(order), target, "proportion")


def histogram(df: DataFrame, column: str, bins: int = 30, trim: tuple | None = (0.01, 0.99),
              accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """D18 + B24: equal-width bin counts over [min, max] of the trimmed values.

    Bins are closed on the left except the last, which holds the maximum.
    """
    data = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    if trim is not None:
        q = quantile_map(df, [column], list(trim), accuracy)
        lo, hi = q[(column, round(trim[0], 12))], q[(column, round(trim[1], 12))]
        data = data.filter((F.col("v") >= lo) & (F.col("v") <= hi))
    mm = data.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return data.select(F.lit(None).cast("int").alias("bin"),
                           F.lit(0).cast("bigint").alias("n")).limit(0)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) + 1
    return (data.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("bin_start", F.lit(lo) + (F.col("bin") - 1) * F.lit(width))
                .withColumn("bin_end", F.lit(lo) + F.col("bin") * F.lit(width)))


def clip_column(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    """Clip a column for plotting."""
    return df.withColumn(column, F.greatest(F.least(F.col(column), F.lit(hi)), F.lit(lo)))


def box_stats_by_class(df: DataFrame, columns: Sequence[str], target: str = P.TARGET,
                       accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers of each column within each class.

    Whiskers are the most extreme values inside the fences (as matplotlib draws).
    """
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], [target], accuracy)
    wide = (q.groupBy(target, "column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
        F.max("n").alias("n")))
    fences = wide.select(target, "column", "q1", "median", "q3", "n",
                         (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo_fence"),
                         (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi_fence"))
    # the fences of a class in one row, so that rows are not turned to a row for each cell
    by_class = fences.groupBy(target).agg(*[
        F.max(F.when(F.col("column") == c, F.struct("lo_fence", "hi_fence"))).alias(f"__f{i}")
        for i, c in enumerate(columns)])
    aggs = []
    for i, c in enumerate(columns):
        v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        inside = (v >= F.col(f"__f{i}.lo_fence")) & (v <= F.col(f"__f{i}.hi_fence"))
        aggs += [F.min(F.when(inside, v)).alias(f"lo{i}"), F.max(F.when(inside, v)).alias(f"hi{i}"),
                 F.count_if(~inside).alias(f"out{i}")]
    whiskers = df.join(F.broadcast(by_class), target).groupBy(target).agg(*aggs).select(target, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("whisker_low"),
                 F.col(f"hi{i}").alias("whisker_high"), F.col(f"out{i}").alias("n_outliers"))
        for i, c in enumerate(columns)])))
    return fences.join(whiskers, [target, "column"]).drop("lo_fence", "hi_fence")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair on pairwise-complete rows.

    Long form (column_a, column_b, corr) with both orders and the diagonal.
    Two scans: per-column means (the shift), then, in Arrow batches, products of
    the matrices of shifted values, their squares and their presence (nulls and
    NaN count as absent, as zero). A task adds up four tables of columns by
    columns, whatever its rows; corr = cov / sqrt(var_x var_y) from the sums.
    Shifting by the mean keeps the sums free of cancellation.
    """
    cols = list(columns)
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    shift = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(value.values())]).first()
    shifted = df.select(*[(v - F.lit(shift[f"m{i}"] or 0.0)).alias(f"v{i}") for i, v in enumerate(value.values())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(cols)
        n, sx, sxx, sxy = np.zeros((4, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(np.float64)
            n += m.T @ m
            sx += x.T @ m
            sxx += (x * x).T @ m
            sxy += x.T @ x
        tables = [n, sx, sx.T, sxx, sxx.T, sxy]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k, dtype=np.int32), k)), pa.array(np.tile(np.arange(k, dtype=np.int32), k)),
             *(pa.array(np.ascontiguousarray(t).ravel()) for t in tables)], names=["i", "j", *SUMS])

    sums = (shifted.mapInArrow(run, "i int, j int, " + ", ".join(f"{s} double" for s in SUMS))
            .groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS]))
    sx, sy, sxx, syy, sxy = (F.col(s) for s in SUMS[1:])
    n = F.nullif(F.col("n"), F.lit(0.0))
    cov, vx, vy = sxy - sx * sy / n, sxx - sx * sx / n, syy - sy * sy / n
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        F.get(names, F.col("i")).alias("column_a"), F.get(names, F.col("j")).alias("column_b"),
        F.when((vx > 0) & (vy > 0), cov / F.sqrt(F.nullif(vx * vy, F.lit(0.0)))).alias("corr"))


def quartile_bands(df: DataFrame, column: str, out: str,
                   accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Qcut into 4 bands; duplicate edges dropped, right-closed, lowest included.

    The band is the 0-based interval index, as pandas' category codes.
    """
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    q = quantile_map(df, [column], probs, accuracy)
    edges = sorted({q[(column, round(p, 12))] for p in probs if q.get((column, round(p, 12))) is not None})
    v = F.col(column)
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = ((v >= lo) if i == 0 else (v > lo)) & (v <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return df.withColumn(out, expr.cast("int"))


def dataset_profile(df: DataFrame, sample_values: int = 3) -> DataFrame:
    """Per column type, non-null count, null percent, distinct count and samples.

    Samples are the smallest distinct values (numeric order for numbers,
    doubles printed with 6 decimals; both zeros count). Each column is read and
    grouped by itself, by its own type, so a column of few values sends few and
    none meets the values of another; samples are a bounded top-k of each part.
    """
    cols = df.columns
    types = dict(df.dtypes)
    numeric = {"int", "bigint", "smallint", "tinyint", "double", "float"}
    row = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    total, nn = row["__total"], {c: row[f"n{i}"] for i, c in enumerate(cols)}

    def values(c):
        v = F.col("v")
        real = types[c] in ("double", "float")
        zero = F.when(v == 0, v.cast("string")) if real else F.lit(None).cast("string")
        own = df.select(F.col(c).alias("v")).filter(v.isNotNull())
        own = own.select("v", zero.alias("zero")).distinct() if real else own.distinct().withColumn("zero", zero)
        raw = F.coalesce("zero", v.cast("string"))
        shown = F.when(F.col("zero").startswith("-"), "-0.000000").otherwise(F.format_string("%.6f", v)) if real else raw
        num = v.cast("double") if types[c] in numeric else F.lit(None).cast("double")
        return own, own.select(F.lit(c).alias("column"), num.alias("num"), raw.alias("raw"), shown.alias("shown"))

    counted = firsts = None
    for c in cols:
        own, shown = values(c)
        n = own.agg(F.count(F.lit(1)).alias("distinct")).select(F.lit(c).alias("column"), "distinct")
        first = shown.orderBy(F.asc_nulls_last("num"), "raw").limit(sample_values)
        counted = n if counted is None else counted.unionByName(n)
        firsts = first if firsts is None else firsts.unionByName(first)
    uniq = counted
    rank = F.struct(F.col("num").isNull().alias("a"), F.col("num").alias("b"), F.col("raw").alias("c"),
                    F.col("shown").alias("shown"))
    samples = firsts.groupBy("column").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(rank)), lambda x: x["shown"]), ", ").alias("samples"))
    meta = df.sparkSession.createDataFrame(
        [(c, types[c], int(nn[c]), round((total - nn[c]) * 100.0 / total, 2) if total else 0.0)
         for c in cols], "column string, dtype string, non_null bigint, null_pct double")
    return (meta.join(uniq, "column", "left").join(samples, "column", "left")
            .na.fill(0, ["distinct"]).withColumnRenamed("column", "column_name"))
