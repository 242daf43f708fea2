"""DuckDB twins of the registered queries (same column names as the Spark side)."""

from __future__ import annotations

from pushback import profile as P
from pushback import oracle as O
from pushback.plans import quality_sql as Q

_CLEAN_COLS = (["row_id"] + [c for c in P.EXPECTED_COLUMNS
                             if c not in P.LEAKAGE_COLUMNS + ["DEPARTURE_DELAY", "CANCELLED"]]
               + [P.TARGET])
CLEANED = f"SELECT * FROM capped WHERE {O.cleaned_where(_CLEAN_COLS)}"


def over_cleaned(body: str, **extra: str) -> str:
    return O.over_enriched(body, **O.cleaned_views(), cleaned=CLEANED, **extra)


def _missing(cols) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)


_ENRICHED_COLS = ["row_id"] + P.EXPECTED_COLUMNS
_ANY_O = " OR ".join(f"{c} IS NULL" for c in P.WEATHER_FIELDS)
_ANY_D = " OR ".join(f"dest_{c} IS NULL" for c in P.WEATHER_FIELDS)

SQL = {
    "class_share_by_hour": over_cleaned(f"""
        SELECT departure_hour, count(*) AS n,
          {", ".join(f"avg(CAST({P.TARGET} = '{c}' AS DOUBLE)) AS {c}_share" for c in P.CLASS_ORDER)},
          1 - avg(CAST({P.TARGET} = 'on_time' AS DOUBLE)) AS not_on_time_share
        FROM cleaned GROUP BY departure_hour"""),
    "flights_view": O.over_flights("SELECT * FROM flights"),
    "weather_hourly": O.WEATHER,
    "enriched_flights": O.over_enriched("SELECT * FROM enriched"),
    "join_coverage": O.over_enriched(f"""
        SELECT (SELECT count(*) FROM flights) AS rows_before, count(*) AS rows_after,
          count(*) FILTER (WHERE {_ANY_O}) AS missing_origin_weather,
          count(*) FILTER (WHERE {_ANY_D}) AS missing_dest_weather,
          round(count(*) FILTER (WHERE {_ANY_O}) * 100.0 / count(*), 2) AS missing_origin_pct,
          round(count(*) FILTER (WHERE {_ANY_D}) * 100.0 / count(*), 2) AS missing_dest_pct
        FROM enriched"""),
    "clean_flights": over_cleaned("SELECT * FROM cleaned"),
    "cleaning_summary": over_cleaned(f"""
        SELECT b.n AS rows_before, {len(_ENRICHED_COLS)} AS columns_before,
               b.m AS missing_cells_before,
               a.n AS rows_after, {len(_CLEAN_COLS)} AS columns_after, a.m AS missing_cells_after,
               b.n - a.n AS rows_dropped, {len(_ENRICHED_COLS) - len(_CLEAN_COLS)} AS columns_dropped
        FROM (SELECT count(*) AS n, {_missing(_ENRICHED_COLS)} AS m FROM enriched) b,
             (SELECT count(*) AS n, {_missing(_CLEAN_COLS)} AS m FROM cleaned) a"""),
}


_E = "enriched"
_EC = _ENRICHED_COLS
_DIMS = {"airlines": O.AIRLINES}
SQL.update({
    "completeness": O.over_enriched(Q.completeness(_E, _EC)),
    "duplicates": O.over_enriched(Q.duplicates(_E, _EC)),
    "range_violations": O.over_enriched(Q.ranges(_E, _EC)),
    "numeric_airport_codes": O.over_enriched(Q.numeric_codes(_E)),
    "consistency": O.over_enriched(Q.consistency(_E)),
    "target_readiness": O.over_enriched(Q.target(_E)),
    "iqr_outliers": O.over_enriched(Q.outliers(_E, _EC)),
    "format_issues": O.over_enriched(Q.formats(_E)),
    "invalid_dates": O.over_enriched(Q.temporal(_E)),
    "cardinality": O.over_enriched(Q.cardinality(_E, _EC)),
    "top_values": O.over_enriched(Q.top_values(_E, _EC)),
    "describe": O.over_enriched(Q.statistics(_E, _EC)),
    "delay_statistics": O.over_enriched(Q.statistics(_E, _EC, ["DEPARTURE_DELAY"])),
    "unknown_codes": O.over_enriched(Q.unknown_codes(_E),
                                     airlines=f"SELECT * FROM ({O.AIRLINES}) WHERE IATA_CODE < 'M'"),
    "validation_report": O.over_enriched(Q.validation_report(_E, _EC), **_DIMS),
    "post_clean_validation": over_cleaned(Q.post_clean("cleaned", _CLEAN_COLS)),
})


from pushback.plans import features_sql as FS  # noqa: E402

_SPLIT = {"split": f"SELECT * FROM ({FS.split_flags('cleaned')})"}
_TRAIN = {**_SPLIT, "train": "SELECT * EXCLUDE (is_test) FROM split WHERE NOT is_test"}
_FEAT = {"feat": f"SELECT c.*, t.* EXCLUDE (row_id) FROM cleaned c JOIN ({FS.temporal('cleaned')}) t USING (row_id)"}
SQL.update({
    "temporal_features": over_cleaned(FS.temporal("cleaned")),
    "congestion_features": over_cleaned(FS.congestion("cleaned")),
    "interaction_keys": over_cleaned(FS.interaction_keys("cleaned")),
    "stratified_sample": O.over_flights(FS.stratified_sample("flights")),
    "train_test_split": over_cleaned(f"SELECT row_id, {P.TARGET}, is_test FROM split", **_SPLIT),
    "cv_folds": over_cleaned(FS.folds("train"), **_TRAIN),
    "frequency_encoding": over_cleaned(FS.frequency("split"), **_SPLIT),
    "smoothed_rates": over_cleaned(FS.smoothed_rates("split"), **_SPLIT),
    "mutual_information": over_cleaned(FS.mutual_information("feat"), **_FEAT),
})

from pushback.plans import eval_sql as EV  # noqa: E402

_PAIRS = {**_SPLIT, "flights": O.FLIGHTS, "arr": EV.ARRIVAL_PAIRS, "maj": EV.MAJORITY_PAIRS}


def over_pairs(body: str, **extra: str) -> str:
    # the fixture flights view is already a CTE of the enriched chain
    views = {k: v for k, v in _PAIRS.items() if k != "flights"}
    return over_cleaned(body, **views, **extra)


_TEST_FEAT = {"test_feat": f"""SELECT c.*, t.* EXCLUDE (row_id) FROM split c
                              JOIN ({FS.temporal('split')}) t USING (row_id) WHERE c.is_test"""}
SQL.update({
    "confusion_matrix": over_pairs(EV.confusion("arr")),
    "core_metrics": over_pairs(EV.core("arr", "arrival_rule") + "\nUNION ALL\n"
                               + EV.core("maj", "majority_baseline")),
    "cost_metrics": over_pairs(EV.cost("arr", "arrival_rule") + "\nUNION ALL\n"
                               + EV.cost("maj", "majority_baseline")),
    "per_class_report": over_pairs(EV.per_class("arr")),
    "weakest_class": over_pairs(EV.weakest("arr")),
    "class_weights": over_pairs(EV.class_weights("train"), train="SELECT * FROM split WHERE NOT is_test"),
    "oversampled_sizes": over_pairs(EV.oversampled("train"), train="SELECT * FROM split WHERE NOT is_test"),
    "majority_baseline": over_pairs("SELECT * FROM maj"),
    "error_summary": over_pairs(EV.error_summary("arr")),
    "confusion_pairs": over_pairs(EV.confusion_pairs("arr")),
    "worst_slices": over_pairs(EV.worst_slices("test_feat", "arr"), **_TEST_FEAT),
    "model_selection": over_pairs(EV.model_selection("runs"),
                                  runs=EV.runs({"arrival_rule": "arr", "majority_baseline": "maj"})),
})

from pushback.plans import catalog as _C  # noqa: E402
from pushback.plans import explore_sql as EX  # noqa: E402

_LABELLED = {"labelled": f"""SELECT *, CAST(CASE {P.TARGET} {" ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(P.CLASS_ORDER))} END AS INTEGER) AS label_ordinal FROM cleaned"""}
_CLIPPED = {"clipped": "SELECT greatest(least(DEPARTURE_DELAY, 200.0), -60.0) AS DEPARTURE_DELAY FROM flights"}
SQL.update({
    "class_distribution": over_cleaned(EX.class_distribution("cleaned")),
    "distance_histogram": over_cleaned(EX.histogram("cleaned", "DISTANCE", 30, (0.01, 0.99))),
    "delay_histogram": O.over_flights(EX.histogram("clipped", "DEPARTURE_DELAY", 80, None), **_CLIPPED),
    "box_stats_by_class": over_cleaned(EX.box_stats("cleaned", _C.BOX_COLUMNS)),
    "origin_class_shares": over_cleaned(EX.crosstab("cleaned", "ORIGIN_AIRPORT", 12)),
    "correlation_matrix": over_cleaned(EX.correlation("labelled", _C.CORR_COLUMNS), **_LABELLED),
    "dataset_profile": over_cleaned(EX.profile("cleaned", _CLEAN_COLS)),
})

SQL.update({
    "stations_to_load": O.with_views("""
        SELECT DISTINCT station FROM (SELECT ORIGIN_AIRPORT AS station FROM flights
                                      UNION ALL SELECT DESTINATION_AIRPORT FROM flights)
        WHERE station IS NOT NULL
          AND station IN (SELECT IATA_CODE FROM airports WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL)
          AND station NOT IN (SELECT station FROM weather WHERE station <> 'NVX')""", **O.BASE_VIEWS),
    "weather_payload_roundtrip": O.WEATHER,
})
