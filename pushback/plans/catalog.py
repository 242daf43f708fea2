"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables through the fixture views, runs over
whole tables, and has a DuckDB twin in ``pushback.plans.oracle_queries``
unless it is a model fit (rows-only check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.operators import cleaning, enrich, explore, quality
from pushback.session import cut_lineage
from pushback.sources import fixture

_MATERIALISED: dict = {}


def _materialised(spark: SparkSession, sf: str, name: str, build):
    """Stage output written once per session to the shared checkpoint folder.

    Like the reference's files between stages, downstream queries read the
    written table instead of recomputing its lineage.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MATERIALISED:
        _MATERIALISED[key] = build()
    return _MATERIALISED[key]


def _has(spark: SparkSession, sf: str, name: str) -> bool:
    return (spark.sparkContext.applicationId, sf, name) in _MATERIALISED


def forget_stages() -> None:
    """Build stage tables anew, as after a change of the input."""
    _MATERIALISED.clear()


def flights_view(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.flights(spark, sf)


def weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.weather_hourly(spark, sf)


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """H1 output, written once per session (the reference's flights_weather file)."""
    return _materialised(spark, sf, "enriched", lambda: cut_lineage(enrich.merge_weather(
        fixture.flights(spark, sf), fixture.weather_hourly(spark, sf),
        fixture.airports(spark, sf)), "enriched"))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """H2 output, written once per session; a written split holds the same rows."""
    if not _has(spark, sf, "cleaned") and _has(spark, sf, "split"):
        return _flagged(spark, sf).drop("is_test")
    return _materialised(spark, sf, "cleaned",
                         lambda: cut_lineage(cleaning.clean(enriched(spark, sf)), "cleaned"))


def join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.join_coverage(fixture.flights(spark, sf), enriched(spark, sf))


def cleaning_summary(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.cleaning_summary(enriched(spark, sf), cleaned(spark, sf))


def class_share_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: enrich -> clean -> class shares per departure hour."""
    return explore.class_share_by(cleaned(spark, sf), "departure_hour")


def _on_enriched(op):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return op(enriched(spark, sf))
    run.__name__ = op.__name__
    return run


def unknown_codes(spark: SparkSession, sf: str) -> DataFrame:
    """C4, with an airline dimension that lacks the codes from 'M' on, which it finds."""
    listed = fixture.airlines(spark, sf).filter(F.col("IATA_CODE") < "M")
    return quality.unknown_codes(enriched(spark, sf), listed, fixture.airports(spark, sf))


def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validation_report(enriched(spark, sf), fixture.airlines(spark, sf),
                                     fixture.airports(spark, sf))


def post_clean_validation(spark: SparkSession, sf: str) -> DataFrame:
    return quality.post_clean_validation(cleaned(spark, sf))


QUERIES = {
    "class_share_by_hour": class_share_by_hour,
    "flights_view": flights_view,
    "weather_hourly": weather_hourly,
    "enriched_flights": enriched,
    "join_coverage": join_coverage,
    "clean_flights": cleaned,
    "cleaning_summary": cleaning_summary,
    "schema_report": _on_enriched(quality.schema_report),
    "completeness": _on_enriched(quality.completeness),
    "duplicates": _on_enriched(quality.duplicates),
    "range_violations": _on_enriched(quality.range_violations),
    "numeric_airport_codes": _on_enriched(quality.numeric_airport_codes),
    "consistency": _on_enriched(quality.consistency),
    "target_readiness": _on_enriched(quality.target_readiness),
    "delay_statistics": _on_enriched(quality.delay_statistics),
    "iqr_outliers": _on_enriched(quality.iqr_outliers),
    "format_issues": _on_enriched(quality.format_issues),
    "invalid_dates": _on_enriched(quality.invalid_dates),
    "cardinality": _on_enriched(quality.cardinality),
    "top_values": _on_enriched(quality.top_k_values),
    "describe": _on_enriched(quality.describe),
    "unknown_codes": unknown_codes,
    "validation_report": validation_report,
    "post_clean_validation": post_clean_validation,
}


# ---- features and sampling --------------------------------------------------------
from pushback.operators import features as FE  # noqa: E402
from pushback.operators import sampling as SA  # noqa: E402

_TEMPORAL = ["is_weekend", "is_holiday", "scheduled_departure_hour_sin",
             "scheduled_departure_hour_cos", "scheduled_arrival_hour_sin",
             "scheduled_arrival_hour_cos", "month_sin", "month_cos", "departure_hour_bucket",
             "departure_hour_bucket_code", "is_morning_peak_bank", "is_evening_peak_bank"]
_CONGESTION = ["origin_hourly_departure_count", "origin_departure_bank_count",
               "origin_congestion_ratio", "origin_departure_bank_ratio",
               "destination_hourly_arrival_count", "destination_departure_bank_count",
               "destination_congestion_ratio", "destination_departure_bank_ratio",
               "origin_weather_intensity", "destination_weather_intensity",
               "origin_congestion_weather_score", "destination_congestion_weather_score",
               "route_congestion_weather_score", "origin_departure_bank_weather_score",
               "destination_departure_bank_weather_score"]
_KEYS = ["ROUTE"] + list(P.INTERACTION_HISTORICAL_KEYS)


def _round_doubles(df: DataFrame, cols) -> DataFrame:
    types = dict(df.dtypes)
    return df.select(*[F.round(c, 9).alias(c) if types[c] == "double" else F.col(c) for c in cols])


def temporal_features(spark: SparkSession, sf: str) -> DataFrame:
    out = FE.add_temporal_features(cleaned(spark, sf))
    return _round_doubles(out, ["row_id"] + _TEMPORAL)


def congestion_features(spark: SparkSession, sf: str) -> DataFrame:
    out = FE.add_weather_scores(FE.add_congestion_features(cleaned(spark, sf)))
    return _round_doubles(out, ["row_id"] + _CONGESTION)


def interaction_keys(spark: SparkSession, sf: str) -> DataFrame:
    out = FE.add_interaction_keys(FE.add_temporal_features(cleaned(spark, sf)))
    return out.select("row_id", *_KEYS)


def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return SA.stratified_sample(fixture.flights(spark, sf), ["MONTH"], P.SAMPLE_FRACTION)


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return SA.split_flags(cleaned(spark, sf)).select("row_id", P.TARGET, "is_test")


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    """E6 output, written once per session. Cleaned rows that no query has asked for are not
    written beside it: cleaning is one pass over the enriched table, as is reading its result."""
    def build():
        rows = cleaned(spark, sf) if _has(spark, sf, "cleaned") else cleaning.clean(enriched(spark, sf))
        return SA.split_table(rows)
    return _materialised(spark, sf, "split", build)


def _split(spark: SparkSession, sf: str):
    return SA.halves(_flagged(spark, sf))


def cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _split(spark, sf)
    return SA.assign_folds(train).select("row_id", P.TARGET, "fold")


def _encoded(spark: SparkSession, sf: str):
    train, test = _split(spark, sf)
    tr = FE.add_interaction_keys(FE.add_temporal_features(train))
    te = FE.add_interaction_keys(FE.add_temporal_features(test))
    return tr, te


def frequency_encoding(spark: SparkSession, sf: str) -> DataFrame:
    tr, te = _encoded(spark, sf)
    tr, te = FE.add_frequency_encoding(tr, te)
    cols = ["row_id"] + [f"{c}_freq" for c in P.FREQUENCY_COLUMNS]
    return (_round_doubles(tr.withColumn("is_test", F.lit(False)), cols + ["is_test"])
            .unionByName(_round_doubles(te.withColumn("is_test", F.lit(True)), cols + ["is_test"])))


def smoothed_rates(spark: SparkSession, sf: str) -> DataFrame:
    tr, te = _encoded(spark, sf)
    keys = {**P.HISTORICAL_KEYS, **P.INTERACTION_HISTORICAL_KEYS}
    tr, te = FE.add_smoothed_rates(tr, te, keys)
    cols = ["row_id"] + [f"{p}_{r}" for p in keys.values() for r in P.HISTORICAL_RATES]
    return (_round_doubles(tr.withColumn("is_test", F.lit(False)), cols + ["is_test"])
            .unionByName(_round_doubles(te.withColumn("is_test", F.lit(True)), cols + ["is_test"])))


_DISCRETE = ["DAY_OF_WEEK", "is_weekend", "is_holiday", "departure_hour_bucket_code",
             "is_morning_peak_bank", "is_evening_peak_bank", "weather_code", "dest_weather_code",
             "DIVERTED"]


def mutual_information(spark: SparkSession, sf: str) -> DataFrame:
    out = FE.add_temporal_features(cleaned(spark, sf))
    mi = FE.mutual_information(out, _DISCRETE)
    return mi.select("column", F.round("mutual_info", 9).alias("mutual_info"))


QUERIES.update({
    "temporal_features": temporal_features,
    "congestion_features": congestion_features,
    "interaction_keys": interaction_keys,
    "stratified_sample": stratified_sample,
    "train_test_split": train_test_split,
    "cv_folds": cv_folds,
    "frequency_encoding": frequency_encoding,
    "smoothed_rates": smoothed_rates,
    "mutual_information": mutual_information,
})


# ---- evaluation ----------------------------------------------------------------------
from pushback.functions.exprs import delay_category  # noqa: E402
from pushback.operators import metrics as ME  # noqa: E402
from pushback.operators import ranking as RK  # noqa: E402


def _test_with_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with the arrival-delay columns of their flight (joined by row_id), which
    the enriched table holds, a row for each flight."""
    _, test = _split(spark, sf)
    test = test.select("row_id", P.TARGET)
    arrival = enriched(spark, sf).select("row_id", "ARRIVAL_DELAY", F.col("CANCELLED").alias("__cancelled"))
    return test.join(arrival, "row_id")


def arrival_rule_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluation fixture: the label binning applied to the arrival delay (a
    post-departure column, so a strong but non-trivial stand-in prediction). Written
    once: every metric reads the pairs again."""
    def build():
        t = _test_with_arrival(spark, sf)
        pred = F.coalesce(delay_category("ARRIVAL_DELAY", "__cancelled"), F.lit("on_time"))
        return cut_lineage(t.select("row_id", F.col(P.TARGET).alias("y_true"), pred.alias("y_pred")), "arrival_pairs")
    return _materialised(spark, sf, "arrival_pairs", build)


def majority_pairs(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return ME.majority_predictions(train, test)


def _candidates(spark: SparkSession, sf: str) -> dict:
    return {"arrival_rule": arrival_rule_pairs(spark, sf),
            "majority_baseline": majority_pairs(spark, sf)}


def _r(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _r(ME.confusion_matrix(arrival_rule_pairs(spark, sf)))


def core_metrics(spark: SparkSession, sf: str) -> DataFrame:
    parts = [ME.core_metrics(p).withColumn("model_mode", F.lit(m))
             for m, p in _candidates(spark, sf).items()]
    return _r(parts[0].unionByName(parts[1]))


def cost_metrics(spark: SparkSession, sf: str) -> DataFrame:
    parts = [ME.cost_metrics(p).withColumn("model_mode", F.lit(m))
             for m, p in _candidates(spark, sf).items()]
    return _r(parts[0].unionByName(parts[1]))


def per_class_report(spark: SparkSession, sf: str) -> DataFrame:
    return _r(ME.per_class_report(arrival_rule_pairs(spark, sf)))


def weakest_class(spark: SparkSession, sf: str) -> DataFrame:
    return _r(ME.weakest_class(ME.per_class_report(arrival_rule_pairs(spark, sf))))


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _split(spark, sf)
    w = ME.class_weights(train)
    return _r(w.groupBy(P.TARGET).agg(F.first("weight").alias("weight"),
                                      F.count(F.lit(1)).alias("n")))


def majority_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return majority_pairs(spark, sf)


def error_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _r(ME.error_summary(arrival_rule_pairs(spark, sf)))


def confusion_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _r(ME.confusion_pairs(arrival_rule_pairs(spark, sf)))


SLICES = ["departure_hour_bucket_code", "DAY_OF_WEEK", "is_weekend", "weather_code",
          "dest_weather_code", "distance_band", "scheduled_time_band"]


def worst_slices(spark: SparkSession, sf: str) -> DataFrame:
    _, test = _split(spark, sf)
    pairs = arrival_rule_pairs(spark, sf).select("row_id", "y_true", "y_pred")
    feats = FE.add_temporal_features(test)
    feats = ME.add_quartile_bands(feats, {"DISTANCE": "distance_band",
                                          "SCHEDULED_TIME": "scheduled_time_band"})
    return _r(ME.worst_slices(feats.join(pairs, "row_id"), SLICES))


def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    runs = None
    for m, p in _candidates(spark, sf).items():
        core = ME.core_metrics(p)
        cost = ME.cost_metrics(p)
        row = core.unionByName(cost, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in RK.CORE + RK.COST]).withColumn("model_mode", F.lit(m))
        runs = row if runs is None else runs.unionByName(row)
    runs = cut_lineage(runs, "runs")
    out = None
    for metric in P.SELECTION_METRICS:
        r = RK.selection_report(runs, metric).select("primary_metric", "rank", "model_mode",
                                                    "is_best", *RK.CORE, *RK.COST)
        out = r if out is None else out.unionByName(r)
    return _r(out)


QUERIES.update({
    "confusion_matrix": confusion_matrix,
    "core_metrics": core_metrics,
    "cost_metrics": cost_metrics,
    "per_class_report": per_class_report,
    "weakest_class": weakest_class,
    "class_weights": class_weights,
    "majority_baseline": majority_baseline,
    "error_summary": error_summary,
    "confusion_pairs": confusion_pairs,
    "worst_slices": worst_slices,
    "model_selection": model_selection,
})


# ---- exploration -----------------------------------------------------------------------
_PLAIN = ["SCHEDULED_TIME", "DISTANCE", "departure_hour", "scheduled_arrival_hour"]
_MEASURED = [c for c in P.WEATHER_FIELDS if c not in ("wind_direction_deg", "weather_code")]
BOX_COLUMNS = (_PLAIN + _MEASURED
               + [P.DEST_PREFIX + c for c in _MEASURED if c not in ("rain_mm", "snowfall_cm")])
CORR_COLUMNS = _PLAIN + _MEASURED + [P.DEST_PREFIX + c for c in _MEASURED] + ["label_ordinal"]


def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return explore.class_distribution(cleaned(spark, sf))


def distance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _r(explore.histogram(cleaned(spark, sf), "DISTANCE", 30, (0.01, 0.99)))


def delay_histogram(spark: SparkSession, sf: str) -> DataFrame:
    f = explore.clip_column(fixture.flights(spark, sf), "DEPARTURE_DELAY", -60.0, 200.0)
    return _r(explore.histogram(f, "DEPARTURE_DELAY", 80, None))


def box_stats_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return _r(explore.box_stats_by_class(cleaned(spark, sf), BOX_COLUMNS))


def origin_class_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _r(explore.normalized_crosstab(cleaned(spark, sf), "ORIGIN_AIRPORT", 12))


def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    from pushback.functions.exprs import label_ordinal
    df = cleaned(spark, sf).withColumn("label_ordinal", label_ordinal(P.TARGET))
    return _r(explore.correlation_matrix(df, CORR_COLUMNS))


def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    return explore.dataset_profile(cleaned(spark, sf))


QUERIES.update({
    "class_distribution": class_distribution,
    "distance_histogram": distance_histogram,
    "delay_histogram": delay_histogram,
    "box_stats_by_class": box_stats_by_class,
    "origin_class_shares": origin_class_shares,
    "correlation_matrix": correlation_matrix,
    "dataset_profile": dataset_profile,
})


# ---- models (rows-only checks: model fits have no SQL twin) ----------------------------
from pushback.plans import training as TR  # noqa: E402
from pushback.plans.models import TrainingConfig, feature_columns  # noqa: E402

# the reference settings, in full
MODEL_CONFIG = TrainingConfig()


def _built(spark: SparkSession, sf: str):
    train, test = _split(spark, sf)
    return FE.build_feature_matrices(train, test)


def _matrices(spark: SparkSession, sf: str):
    """Both matrices, written once: every fit reads them many times."""
    return _materialised(spark, sf, "matrices", lambda: tuple(
        cut_lineage(df, name) for df, name in zip(_built(spark, sf), ("train_matrix", "test_matrix"))))


def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """H5: train and test feature matrices (label and row_id kept), one frame. They are
    not written for this query, which reads them once; those written for fits are used."""
    tr, te = _matrices(spark, sf) if _has(spark, sf, "matrices") else _built(spark, sf)
    return tr.withColumn("is_test", F.lit(False)).unionByName(te.withColumn("is_test", F.lit(True)))


def _holdout(mode: str, what: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tr, te = _matrices(spark, sf)
        return TR.train_and_evaluate(mode, tr, te, MODEL_CONFIG)[1]
    run.__name__, run.__doc__ = f"{mode}_holdout", f"G12: {what} fitted on train, holdout predictions."
    return run


holdout_predictions = _holdout("logreg_balanced", "balanced logistic regression")


def model_runs(spark: SparkSession, sf: str) -> DataFrame:
    """G18 + F2 over the linear modes and the baseline, ranked among themselves;
    each other mode has its own query."""
    tr, te = _matrices(spark, sf)
    ranked = TR.run_all_models(tr, te, ["majority_baseline", "logreg_balanced", "logreg_unbalanced"], MODEL_CONFIG)
    return ranked.select("rank", "model_mode", "is_best", *RK.CORE, *RK.COST)


def plain_cv_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Stratified k-fold CV of balanced logistic regression on the encoded
    training matrix (encodings fitted before folding, as in the reference)."""
    tr, _ = _matrices(spark, sf)
    res = TR.fold_scores("logreg_balanced", tr, cfg=MODEL_CONFIG)
    names = sorted(res)
    return spark.createDataFrame([tuple(float(res[n]) for n in names)],
                                 ", ".join(f"{n} double" for n in names))


def oversampled_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """G1 over the whole training matrix: rows and synthetic rows of each class."""
    tr, _ = _matrices(spark, sf)
    out = TR.oversampled(tr, MODEL_CONFIG)
    made = F.col("row_id").contains("~s")
    return out.groupBy(P.TARGET).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(made).alias("n_synthetic"),
                                     F.count_distinct(F.when(~made, F.col("row_id"))).alias("n_source"))


def neighbour_information(spark: SparkSession, sf: str) -> DataFrame:
    """D29 by nearest neighbours, over every numeric column of the training matrix."""
    from pushback.operators.nearest_information import nearest_mutual_information
    tr, _ = _matrices(spark, sf)
    scores = nearest_mutual_information(tr, feature_columns(tr))
    return scores.select("column", F.round("mutual_info", 6).alias("mutual_info"))


QUERIES.update({
    "feature_matrix": feature_matrix,
    "holdout_predictions": holdout_predictions,
    "model_runs": model_runs,
    "plain_cv_scores": plain_cv_scores,
})

# fits of a minute and more, which come last where all queries run
LONG_QUERIES = {
    "oversampled_sizes": oversampled_sizes,
    "neighbour_information": neighbour_information,
    "boosted_holdout": _holdout("hist_gradient_boosting", "histogram boosting"),
    "two_stage_holdout": _holdout("hierarchical_hist_gradient_boosting", "two-stage histogram boosting"),
    "forest_holdout": _holdout("random_forest", "random forest"),
    "extra_trees_holdout": _holdout("extra_trees", "extra trees"),
}


# ---- sources ---------------------------------------------------------------------------
from pushback.sources import weather_json as WJ  # noqa: E402


def stations_to_load(spark: SparkSession, sf: str) -> DataFrame:
    """A5, with the weather of one station not loaded yet, which is what it finds."""
    gap = fixture.airport_code(F.lit(fixture.STATION_NOT_LOADED))
    loaded = fixture.weather_hourly(spark, sf).filter(F.col("station") != gap)
    return WJ.stations_to_load(fixture.flights(spark, sf), fixture.airports(spark, sf), loaded)


def weather_payload_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A4: hourly rows -> JSON payload files (one folder per station) -> flattened rows."""
    import os
    from pushback.session import ensure_checkpoint_dir
    events = fixture.read_table(spark, sf, "events")
    year = events.agg(F.min(F.year("ts"))).first()[0]
    folder = os.path.join(ensure_checkpoint_dir(spark), f"weather-payloads-{os.getpid()}-{id(spark)}")
    payloads = WJ.payloads_from_hourly(fixture.weather_hourly(spark, sf), year)
    payloads.select("station", "hourly").write.mode("overwrite").partitionBy("station").json(folder)
    return WJ.flatten_hourly(WJ.read_payloads(spark, folder))


QUERIES.update({
    "stations_to_load": stations_to_load,
    "weather_payload_roundtrip": weather_payload_roundtrip,
})
