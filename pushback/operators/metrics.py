"""Classification metrics on (y_true, y_pred) columns.

Everything reduces to the confusion counts — one aggregate with at most
classes x classes groups — so a metric costs one scan of the predictions
however many rows they hold. The class lists are fixed and bounded, so
literal tables of them are joined by broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.operators.explore import quartile_bands


def confusion_counts(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """(y_true, y_pred, n) for the observed pairs."""
    return pred.groupBy(F.col(y_true).alias("y_true"), F.col(y_pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))


def _class_grid(spark, order: Sequence[str]) -> DataFrame:
    rows = [(t, i, p, j) for i, t in enumerate(order) for j, p in enumerate(order)]
    return spark.createDataFrame(rows, "y_true string, true_order int, y_pred string, pred_order int")


def confusion_matrix(pred: DataFrame, order: Sequence[str] = P.CLASS_ORDER,
                     y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """The fixed-order k x k grid of counts and row-normalised shares."""
    counts = confusion_counts(pred, y_true, y_pred)
    grid = F.broadcast(_class_grid(pred.sparkSession, order))
    full = grid.join(counts, ["y_true", "y_pred"], "left").na.fill(0, ["n"])
    row_total = F.sum("n").over(Window.partitionBy("y_true"))  # k rows per partition
    return full.select("y_true", "y_pred", "true_order", "pred_order", "n",
                       F.coalesce(F.try_divide(F.col("n"), row_total), F.lit(0.0)).alias("row_share"))


def _per_label(counts: DataFrame) -> DataFrame:
    """Per label: tp, support (true count), predicted count."""
    t = counts.groupBy(F.col("y_true").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("tp"))
    p = counts.groupBy(F.col("y_pred").alias("label")).agg(F.sum("n").alias("predicted"))
    return (t.join(p, "label", "full_outer")
             .na.fill(0, ["support", "tp", "predicted"]))


def _prf(df: DataFrame) -> DataFrame:
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return df.withColumn("precision", prec).withColumn("recall", rec).withColumn("f1_score", f1)


def core_metrics(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Accuracy, balanced accuracy (mean recall over true classes), macro F1
    (over the union of true and predicted labels) and support-weighted F1."""
    per = _prf(_per_label(confusion_counts(pred, y_true, y_pred)))
    n = F.sum("support")
    return per.agg(
        (F.sum("tp") / n).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1_score").alias("macro_f1"),
        (F.sum(F.col("f1_score") * F.col("support")) / n).alias("weighted_f1"))


def per_class_report(pred: DataFrame, order: Sequence[str] = P.CLASS_ORDER,
                     y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support for each class of the fixed order."""
    per = _per_label(confusion_counts(pred, y_true, y_pred))
    labels = pred.sparkSession.createDataFrame([(c, i) for i, c in enumerate(order)],
                                               "label string, class_order int")
    full = F.broadcast(labels).join(per, "label", "left").na.fill(0, ["support", "tp", "predicted"])
    return _prf(full).select("label", "class_order", "precision", "recall", "f1_score",
                             F.col("support").cast("bigint").alias("support"))


def _cost_of(label: Column, costs: dict) -> Column:
    lookup = F.create_map(*[x for k, v in costs.items() for x in (F.lit(k), F.lit(float(v)))])
    cost = lookup[label]
    return F.when(label.isNull() | cost.isNotNull(), cost).otherwise(
        F.raise_error(F.concat(F.lit("unknown label in cost lookup: "), label)))


def cost_metrics(pred: DataFrame, costs: dict = P.MISCLASS_COST, baseline: str = "on_time",
                 y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Average penalty of errors (by true class), all-``baseline`` average, and the
    reduction; an empty input gives zeros. An unknown true label raises."""
    t = F.col(y_true)
    cost = _cost_of(t, costs)
    err = F.when(t != F.col(y_pred), cost).otherwise(0.0)
    base = F.when(t != F.lit(baseline), cost).otherwise(0.0)
    n = F.count(F.lit(1))
    out = pred.agg(F.coalesce(F.sum(err) / n, F.lit(0.0)).alias("average_misclassification_cost"),
                   F.coalesce(F.sum(base) / n, F.lit(0.0)).alias("baseline_on_time_average_cost"))
    return out.withColumn("cost_reduction_vs_on_time_baseline",
                          F.col("baseline_on_time_average_cost")
                          - F.col("average_misclassification_cost"))


def metrics_of_cells(cells: dict, costs: dict = P.MISCLASS_COST, baseline: str = "on_time") -> tuple[dict, dict]:
    """D24 and D26 from the counts of (true, predicted) cells, of which there
    are at most classes times classes: (core metrics, cost metrics)."""
    n = sum(cells.values())
    true, predicted, right = {}, {}, {}
    for (t, p), c in cells.items():
        true[t] = true.get(t, 0) + c
        predicted[p] = predicted.get(p, 0) + c
        right[t] = right.get(t, 0) + (c if t == p else 0)
    unknown = [t for t in true if t is not None and t not in costs]
    if unknown:
        raise ValueError(f"labels without a cost: {unknown}")
    labels = {x for x in (*true, *predicted) if x is not None}
    f1 = {x: 2 * right.get(x, 0) / (true.get(x, 0) + predicted.get(x, 0)) for x in labels}
    recalls = [right[t] / c for t, c in true.items()]
    share = lambda total: total / n if n else 0.0
    core = {"accuracy": share(sum(right.values())),
            "balanced_accuracy": sum(recalls) / len(recalls) if recalls else 0.0,
            "macro_f1": sum(f1.values()) / len(f1) if f1 else 0.0,
            "weighted_f1": share(sum(f1[t] * c for t, c in true.items() if t is not None))}
    paid = share(sum(costs[t] * c for (t, p), c in cells.items() if t is not None and t != p))
    plain = share(sum(costs[t] * c for t, c in true.items() if t is not None and t != baseline))
    return core, {"average_misclassification_cost": paid, "baseline_on_time_average_cost": plain,
                  "cost_reduction_vs_on_time_baseline": plain - paid}


def class_weights(df: DataFrame, label: str = P.TARGET, weight: str = "weight") -> DataFrame:
    """D27: "balanced" weight n / (k * n_class) as a column (class counts: k rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = counts.agg(F.sum("__nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = counts.select(label, (F.lit(tot["n"]) / (F.lit(tot["k"]) * F.col("__nc"))).alias(weight))
    return df.join(F.broadcast(w), label, "left")


def majority_class(df: DataFrame, label: str = P.TARGET) -> str | None:
    """Most frequent label (ties: smallest label)."""
    row = (df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), F.asc(label)).first())
    return None if row is None else row[label]


def majority_predictions(train: DataFrame, test: DataFrame, label: str = P.TARGET,
                         row_id: str = "row_id") -> DataFrame:
    """Every test row predicted as the training majority class."""
    top = majority_class(train, label)
    return test.select(row_id, F.col(label).alias("y_true"), F.lit(top).alias("y_pred"))


def error_summary(pred: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Rows, errors and error rate."""
    err = (F.col(y_true) != F.col(y_pred)).cast("int")
    return pred.agg(F.count(F.lit(1)).alias("rows"), F.sum(err).alias("errors"),
                    F.avg(err.cast("double")).alias("error_rate"))


def confusion_pairs(pred: DataFrame, top: int = 8, y_true: str = "y_true",
                    y_pred: str = "y_pred") -> DataFrame:
    """error pairs with count and share of all errors, largest first."""
    errs = pred.filter(F.col(y_true) != F.col(y_pred))
    counts = confusion_counts(errs, y_true, y_pred)
    total = errs.count()
    return (counts.withColumn("share_of_errors", F.col("n") / F.lit(max(total, 1)))
                  .withColumn("pair", F.concat_ws(" -> ", "y_true", "y_pred"))
                  .orderBy(F.desc("n"), F.asc("pair")).limit(top))


def worst_slices(df: DataFrame, slices: Sequence[str], min_rows: int = 150, top: int = 10,
                 y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """F6 + F7: error rate per (slice column, value), groups of at least ``min_rows``,
    highest rate then largest size first. One unpivot, one aggregate."""
    err = (F.col(y_true) != F.col(y_pred)).cast("double")
    cols = list(slices)
    long = (df.select(err.alias("__e"), *[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot("__e", cols, "feature", "segment"))
    agg = long.groupBy("feature", "segment").agg(F.count(F.lit(1)).alias("samples"),
                                                 F.avg("__e").alias("error_rate"))
    return (agg.filter(F.col("samples") >= min_rows)
               .orderBy(F.desc("error_rate"), F.desc("samples"), F.asc("feature"), F.asc("segment"))
               .limit(top))


def weakest_class(report: DataFrame) -> DataFrame:
    """the class with the lowest recall (ties: fixed class order)."""
    return report.orderBy(F.asc("recall"), F.asc("class_order")).limit(1)


def add_quartile_bands(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """E8 for several columns: {source column: band column}."""
    for src, out in columns.items():
        df = quartile_bands(df, src, out)
    return df
