from dataclasses import replace

import pytest

from pushback import profile as P
from pushback.plans import models as M
from pushback.plans import training as TR
from pushback.operators import sampling as SA
from pushback.session import cut_lineage
from pyspark.sql import functions as F

FAST = M.TrainingConfig(max_iter=30, rf_n_estimators=3, rf_max_depth=4, hgb_max_depth=3)
FEW = replace(FAST, max_iter=2)  # boosting rounds


def _toy(spark, n=120):
    rows = []
    for i in range(n):
        c = i % 4
        rows.append((f"r{i}", P.CLASS_ORDER[c], float(c) + (i % 7) * 0.01, float(c * c) - (i % 5) * 0.02))
    return spark.createDataFrame(rows, f"row_id string, {P.TARGET} string, feature_a double, feature_b double")


def test_unknown_mode_raises(spark):
    with pytest.raises(ValueError):
        M.train_model("svm", _toy(spark), FAST)


@pytest.mark.parametrize("mode", ["logreg_balanced", "random_forest", "hist_gradient_boosting",
                                  "hierarchical_hist_gradient_boosting", "extra_trees",
                                  "xgboost_balanced", "logreg_unbalanced", "majority_baseline"])
def test_every_mode_fits_and_predicts_known_labels(spark, mode):
    df = _toy(spark)
    fitted = M.train_model(mode, df, FEW if "hist" in mode else FAST)
    preds = fitted.predict(df).select("y_pred").distinct().collect()
    assert {r.y_pred for r in preds} <= set(P.CLASS_ORDER)


def test_separable_data_is_learned(spark):
    df = _toy(spark)
    summary, pairs = TR.train_and_evaluate("logreg_balanced", df, df, FAST)
    assert summary["metrics"]["balanced_accuracy"] > 0.9
    assert pairs.count() == df.count()


def test_run_all_models_ranks_each_mode_once(spark):
    df = _toy(spark)
    ranked = TR.run_all_models(df, df, ["majority_baseline", "logreg_balanced"], FAST).collect()
    assert sorted(r["rank"] for r in ranked) == [1, 2]
    assert [r.model_mode for r in ranked if r["rank"] == 1] == ["logreg_balanced"]


@pytest.mark.parametrize("mode", ["logreg_balanced", "hierarchical_hist_gradient_boosting", "majority_baseline"])
def test_saved_models_predict_the_same(spark, tmp_path, mode):
    df = _toy(spark)
    fitted = M.train_model(mode, df, FEW)
    path = (tmp_path / "m").as_uri()
    fitted.save(path)
    loaded = M.load_model(path)
    rows = lambda m: sorted((r.row_id, r.y_pred) for r in m.predict(df).collect())
    assert rows(loaded) == rows(fitted)
    assert loaded.columns == fitted.columns
    report, _ = TR.score_batch(loaded, df, str(tmp_path / "pred"))
    assert set(report["per_class"]) == set(P.CLASS_ORDER)


def test_parameters_reach_the_learners(spark):
    df = _toy(spark)
    hgb = M.train_model("hist_gradient_boosting", df, replace(FEW, hgb_l2_regularization=0.5, hgb_max_leaf_nodes=2))
    assert hgb.rounds == [2] and all(len(t.left) <= 3 for r in hgb.learners[0].trees for t in r)
    assert M.boost_settings(replace(FEW, hgb_l2_regularization=0.5)).l2 == 0.5
    assert M.second_order_settings(replace(FAST, rf_max_depth=None)).max_depth == 6
    xgb = M.train_model("xgboost_balanced", df, replace(FAST, rf_n_estimators=2, rf_max_depth=2))
    assert xgb.rounds == [2]
    extra = M.train_model("extra_trees", df, replace(FAST, rf_class_weight=None, rf_max_depth=31)).learners[0]
    assert len(extra.trees) == 3 and extra.trees[0].value[0].tolist() == [30.0] * 4  # rows count as they are
    with pytest.raises(ValueError):
        TR._config_for({"no_such_parameter": 0.1}, FAST)


def test_report_files_take_their_mode_from_the_stem(spark, tmp_path):
    (tmp_path / "quick_run.json").write_text('{"core_metrics": {"balanced_accuracy": 0.5}}')
    assert TR.read_report(spark, str(tmp_path)).first().model_mode == "quick_run"


def test_draw_parameters_is_seeded_and_distinct():
    a = TR.draw_parameters(TR.RF_SEARCH_SPACE, 30, 42)
    b = TR.draw_parameters(TR.RF_SEARCH_SPACE, 30, 42)
    assert a == b and len({tuple(sorted(d.items(), key=str)) for d in a}) == 30
    for d in a:
        assert all(d[k] in TR.RF_SEARCH_SPACE[k] for k in d)
    assert len(TR.draw_parameters(TR.RF_SEARCH_SPACE, 1000, 1)) == 128


def test_folds_are_built_once_for_any_number_of_trials(spark, monkeypatch):
    built = []

    def matrices(train, test, **options):  # the encodings have their own tests
        built.append((train.count(), test.count()))
        return train, test

    monkeypatch.setattr(TR.FE, "build_feature_matrices", matrices)
    df = _toy(spark)
    report, top = TR.tune("logreg_balanced", df, df, {"max_iter": [1, 2, 5]}, n_iter=3, base=FAST, k=2)
    assert built == [(60, 60), (60, 60), (120, 120)]
    assert top.count() == 3 and report["best_params"]["max_iter"] in (1, 2, 5)


def test_a_search_goes_on_where_it_was_broken_off(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(TR, "fold_matrices", lambda df, *_: [(df, df)])
    fits, real = [], TR.score_folds

    def scored(mode, folds, cfg, metric):
        if len(fits) == 2 and not resumed:
            raise KeyboardInterrupt  # the driver is lost
        fits.append(cfg.max_iter)
        return real(mode, folds, cfg, metric)

    monkeypatch.setattr(TR, "score_folds", scored)
    df, space, resumed = _toy(spark, 40), {"max_iter": [1, 2, 3, 5]}, False
    path = (tmp_path / "trials").as_uri()
    with pytest.raises(KeyboardInterrupt):
        TR.search("logreg_balanced", df, space, 4, base=FAST, k=2, trials_path=path)
    resumed = True
    trials = TR.search("logreg_balanced", df, space, 4, base=FAST, k=2, trials_path=path, parallel=2).collect()
    assert sorted(fits) == [1, 2, 3, 5] and [r.trial for r in trials] == [0, 1, 2, 3]
    TR.search("logreg_balanced", df, space, 4, base=FAST, k=2, trials_path=path)
    assert len(fits) == 4
    TR.search("logreg_balanced", df, space, 1, "cost", base=FAST, k=2, trials_path=path)
    assert len(fits) == 5  # another metric is another trial


def test_a_run_logged_twice_is_one_row(spark, tmp_path):
    path = (tmp_path / "runs").as_uri()
    run = {"run_id": "7", "model_mode": "m", "run_name": "a-m", "metrics": {"accuracy": 0.5}, "cost_metrics": {"c": 1.0},
           "train_metrics": {"accuracy": 0.9}, "cv_metrics": {"cv_accuracy": 0.4}, "params": {"depth": None, "rate": 0.1},
           "tags": {"stage": "baseline_training", "model_family": "m"}}
    TR.log_runs(TR.runs_frame(spark, [run]), path)
    TR.log_runs(TR.runs_frame(spark, [run | {"run_id": "8"}]), path)
    TR.log_runs(TR.runs_frame(spark, [run | {"metrics": {"accuracy": 0.6}}]), path)
    rows = {r.run_id: r for r in TR.read_runs(spark, path).collect()}
    assert rows.keys() == {"7", "8"} and rows["7"].metrics == {"accuracy": 0.6} and rows["8"].metrics == {"accuracy": 0.5}
    assert rows["7"].params == {"depth": "null", "rate": "0.1"} and rows["7"].cv_metrics == {"cv_accuracy": 0.4}
    assert rows["7"].tags == run["tags"] and rows["7"].train_metrics == {"accuracy": 0.9}


def test_training_oversamples_selects_and_cross_validates(spark):
    df = _toy(spark).filter(f"{P.TARGET} <> 'cancelled' OR row_id IN ('r3', 'r7', 'r11', 'r15', 'r19', 'r23')")
    df = df.withColumn("still", F.lit(1.0))
    summary, _ = TR.train_and_evaluate("logreg_balanced", df, df, FAST, use_smote=True, selection="mutual_info",
                                       min_mutual_info=0.1, with_cv=True, k=2)
    assert "still" not in summary["selected_columns"] and set(summary["selected_columns"]) <= {"feature_a", "feature_b"}
    assert set(summary["cv_metrics"]) == {"cv_accuracy", "cv_balanced_accuracy", "cv_macro_f1", "cv_weighted_f1"}
    assert summary["params"]["selected_feature_columns"] == len(summary["selected_columns"]) < summary["params"]["feature_columns"]
    assert summary["metrics"]["balanced_accuracy"] > 0.8


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _flights(spark, n):
    from pushback.operators import cleaning, enrich
    from pushback.sources import fixture
    sf = "/root/testdata/sf0.001"
    flights = fixture.flights(spark, sf).orderBy("row_id").limit(n)
    table = enrich.merge_weather(flights, fixture.weather_hourly(spark, sf), fixture.airports(spark, sf))
    return cut_lineage(cleaning.clean(table), "cleaned")


def test_honest_cv_rebuilds_every_encoding_on_real_features(spark, monkeypatch, few_partitions):
    train, built, real = _flights(spark, 500), [], TR.fold_matrices

    def kept(*args):  # the real matrices, looked at below
        built.extend(real(*args))
        return built

    monkeypatch.setattr(TR, "fold_matrices", kept)
    res = TR.honest_cv("logreg_balanced", train, FAST, k=2)
    assert res["folds"] == 2 and 0.1 < res["mean_score"] < 0.9 and res["selection_score"] == res["mean_score"]
    assert sum(va.count() for _, va in built) == train.count()
    for tr, va in built:
        assert set(tr.columns) == set(va.columns) and any("_historical_" in c for c in tr.columns)
        assert tr.join(va, "row_id").count() == 0
    rates = [c for c in built[0][0].columns if "_historical_" in c]
    ids = [{r.row_id for r in tr.select("row_id").collect()} for tr, _ in built]
    assert len(rates) == 60 and not ids[0] & ids[1]


def test_tuning_on_real_features_refits_and_reports(spark, tmp_path, few_partitions):
    rows = _flights(spark, 400)
    train, test = SA.split_dataset(rows)
    report, top = TR.tune("logreg_balanced", train, test, {"max_iter": [1, 3]}, n_iter=2, base=FAST, k=2,
                          trials_path=(tmp_path / "t").as_uri(), model_path=(tmp_path / "m").as_uri())
    assert top.count() == 2 and report["cv_folds"] == 2 and report["best_params"]["max_iter"] in (1, 3)
    assert report["predictions"].count() == test.count()
    loaded = M.load_model((tmp_path / "m").as_uri())
    assert loaded.mode == "logreg_balanced"
