import pytest
from pyspark.sql import functions as F

from pushback.operators import metrics as ME
from pushback.operators import ranking as RK


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "y_true string, y_pred string")


def test_cost_metrics(spark):
    p = _pairs(spark, [("minor_delay", "on_time"), ("major_delay", "on_time"),
                       ("cancelled", "on_time"), ("on_time", "on_time")])
    r = ME.cost_metrics(p).first()
    assert r.average_misclassification_cost == pytest.approx((5 + 8 + 10) / 4)
    assert r.baseline_on_time_average_cost == pytest.approx((5 + 8 + 10) / 4)
    assert r.cost_reduction_vs_on_time_baseline == pytest.approx(0.0)


def test_cost_metrics_empty_is_zero(spark):
    r = ME.cost_metrics(_pairs(spark, [])).first()
    assert r.average_misclassification_cost == 0.0


def test_cost_unknown_label_raises(spark):
    with pytest.raises(Exception):
        ME.cost_metrics(_pairs(spark, [("mystery", "on_time")])).collect()


def test_majority_baseline_balanced_accuracy(spark):
    train = spark.createDataFrame([("a", "on_time"), ("b", "on_time"), ("c", "cancelled"),
                                   ("d", "minor_delay")], "row_id string, DELAY_CATEGORY string")
    test = spark.createDataFrame([("e", "on_time"), ("f", "major_delay"), ("g", "cancelled"),
                                  ("h", "minor_delay")], "row_id string, DELAY_CATEGORY string")
    p = ME.majority_predictions(train, test)
    r = ME.core_metrics(p).first()
    assert r.balanced_accuracy == pytest.approx(0.25)
    assert r.accuracy == pytest.approx(0.25)


def test_core_metrics_against_hand_computation(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), ("c", "c")]
    r = ME.core_metrics(_pairs(spark, rows)).first()
    # per class (precision, recall): a (1/2, 1/2), b (2/3, 1), c (1, 1/2)
    f1 = {"a": 0.5, "b": 0.8, "c": 2 / 3}
    assert r.accuracy == pytest.approx(4 / 6)
    assert r.balanced_accuracy == pytest.approx((0.5 + 1 + 0.5) / 3)
    assert r.macro_f1 == pytest.approx(sum(f1.values()) / 3)
    assert r.weighted_f1 == pytest.approx((2 * f1["a"] + 2 * f1["b"] + 2 * f1["c"]) / 6)


def test_macro_f1_counts_predicted_only_labels(spark):
    r = ME.core_metrics(_pairs(spark, [("a", "a"), ("a", "z")])).first()
    # labels {a, z}: F1(a) = 2/3, F1(z) = 0; balanced accuracy only over true labels
    assert r.macro_f1 == pytest.approx(1 / 3)
    assert r.balanced_accuracy == pytest.approx(0.5)


def test_confusion_matrix_fixed_grid(spark):
    p = _pairs(spark, [("on_time", "on_time"), ("cancelled", "on_time")])
    cm = ME.confusion_matrix(p).collect()
    assert len(cm) == 16 and sum(r.n for r in cm) == 2


def _runs(spark, rows):
    """(mode, balanced accuracy, macro F1, weighted F1, cost, reduction) rows."""
    return spark.createDataFrame(
        [(m, {"balanced_accuracy": ba, "macro_f1": mf, "weighted_f1": wf},
          {"average_misclassification_cost": c, "cost_reduction_vs_on_time_baseline": r})
         for m, ba, mf, wf, c, r in rows],
        "model_mode string, metrics map<string,double>, cost_metrics map<string,double>")


def test_ranking_reaches_every_tie_break(spark):
    runs = _runs(spark, [
        ("z", 0.7, 0.5, 0.8, 2.0, 0.3), ("y", 0.6, 0.9, 0.1, 9.0, 0.0),  # measure itself
        ("x", 0.6, 0.8, 0.9, 1.0, 0.9),                                  # macro F1
        ("w", 0.6, 0.8, 0.9, 1.5, 0.9),                                  # cost
        ("v", 0.6, 0.8, 0.9, 1.5, 0.7),                                  # reduction
        ("u", 0.6, 0.8, 0.4, 1.5, 0.7), ("t", 0.6, 0.8, None, 1.5, 0.7),  # weighted F1, absent last
        ("b", 0.1, 0.1, 0.1, 1.0, 0.1), ("a", 0.1, 0.1, 0.1, 1.0, 0.1)])  # name
    ranked = RK.selection_report(runs, "balanced_accuracy").orderBy("rank").collect()
    assert "".join(r.model_mode for r in ranked) == "zyxwvutab"
    by_cost = RK.selection_report(runs, "cost").orderBy("rank").collect()
    assert "".join(r.model_mode for r in by_cost) == "xabwvutzy"
    assert ranked[0].tie_breakers.split(",") == RK.tie_breakers("balanced_accuracy")
    with pytest.raises(ValueError):
        RK.selection_report(runs, "speed")


def test_ranking_fails_on_a_run_without_metrics(spark):
    runs = _runs(spark, [("a", 0.5, 0.5, 0.5, 1.0, 0.1)])
    for gap in ("metrics", "cost_metrics"):
        broken = runs.unionByName(runs.withColumn(gap, F.lit(None).cast("map<string,double>")))
        with pytest.raises(Exception, match="without"):
            RK.rank_candidates(broken).collect()
    with pytest.raises(Exception, match="no mode"):
        RK.rank_candidates(runs.withColumn("model_mode", F.lit(""))).collect()


def test_ranking_takes_the_holdout_block_of_a_report(spark):
    both = spark.createDataFrame(
        [("m", ({"balanced_accuracy": 0.4, "macro_f1": 0.3}, {"average_misclassification_cost": 2.0}),
          {"balanced_accuracy": 0.9, "macro_f1": 0.9}, {"average_misclassification_cost": 0.1})],
        "model_mode string, holdout_report struct<core_metrics: map<string,double>, cost_metrics: map<string,double>>,"
        "core_metrics map<string,double>, cost_metrics map<string,double>")
    r = RK.resolve_metrics(both).first()
    assert (r.balanced_accuracy, r.average_misclassification_cost) == (0.4, 2.0)


def test_metrics_of_cells_equal_the_aggregates(spark):
    rows = [("on_time", "on_time")] * 5 + [("on_time", "cancelled"), ("major_delay", "on_time"),
                                           ("cancelled", "cancelled"), ("minor_delay", "major_delay")] * 2
    pairs = _pairs(spark, rows)
    core, cost = ME.metrics_of_cells({k: rows.count(k) for k in set(rows)})
    for got, want in ((core, ME.core_metrics(pairs).first()), (cost, ME.cost_metrics(pairs).first())):
        assert got == pytest.approx(want.asDict())


def test_ranking_reads_holdout_report(spark):
    runs = spark.createDataFrame([
        ("m1", ({"balanced_accuracy": 0.3, "macro_f1": 0.2}, {"average_misclassification_cost": 1.0,
                                                              "cost_reduction_vs_on_time_baseline": 0.1})),
        ("m2", ({"balanced_accuracy": 0.5, "macro_f1": 0.2}, {"average_misclassification_cost": 1.0,
                                                              "cost_reduction_vs_on_time_baseline": 0.1})),
    ], "model_mode string, holdout_report struct<core_metrics: map<string,double>, "
       "cost_metrics: map<string,double>>")
    ranked = RK.rank_candidates(runs).orderBy("rank").collect()
    assert [r.model_mode for r in ranked] == ["m2", "m1"]


def test_artifact_names(spark):
    from pyspark.sql import functions as F
    r = spark.range(1).select(
        RK.run_name(F.lit("exp 1"), F.lit("random_forest"), F.lit(True)).alias("a"),
        RK.artifact_stem(F.lit("exp 1/x"), F.lit("random_forest"), F.lit(False)).alias("b"),
        RK.selection_stem(F.lit("exp 1"), F.lit(True)).alias("c")).first()
    assert r.a == "exp 1-random_forest-smote"
    assert r.b == "exp_1_x-random_forest"
    assert r.c == "exp_1-best-model-smote"
