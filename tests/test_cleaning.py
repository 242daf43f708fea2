import numpy as np
import pytest

from pushback import profile as P
from pushback.operators import cleaning


def test_drop_numeric_code_rows_keeps_three_of_five(spark):
    rows = [(1, "ATL", "LAX", 0), (2, "14747", "SFO", 0), (3, "JFK", "10397", 0),
            (4, "ORD", "DFW", 0), (5, "SEA", "BOS", 1)]
    df = spark.createDataFrame(rows, "FLIGHT_NUMBER int, ORIGIN_AIRPORT string, "
                                     "DESTINATION_AIRPORT string, CANCELLED int")
    out = cleaning.drop_numeric_code_rows(df)
    assert sorted(r.FLIGHT_NUMBER for r in out.collect()) == [1, 4, 5]


def test_null_airport_code_is_kept(spark):
    df = spark.createDataFrame([(None, "LAX"), ("ATL", None), (None, "123")],
                               "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    assert cleaning.drop_numeric_code_rows(df).count() == 2


def test_target_edges(spark):
    delays = [-10.0, 0.0, 15.0, 16.0, 45.0, 46.0, 100.0, None, None]
    cancelled = [0, 0, 0, 0, 0, 0, 0, 1, 0]
    df = spark.createDataFrame(list(zip(range(9), delays, cancelled)),
                               "i int, DEPARTURE_DELAY double, CANCELLED int")
    out = {r.i: r[P.TARGET] for r in cleaning.add_target(df).collect()}
    assert [out[i] for i in range(9)] == ["on_time"] * 3 + ["minor_delay"] * 2 + \
        ["major_delay"] * 2 + ["cancelled", None]
    assert "DEPARTURE_DELAY" not in cleaning.add_target(df).columns


def test_drop_null_label(spark):
    df = spark.createDataFrame([("on_time",), (None,), ("cancelled",), ("major_delay",)],
                               f"{P.TARGET} string")
    assert cleaning.drop_null_label(df).count() == 3


def test_capping_matches_numpy_and_skips_other_columns(spark):
    values = list(range(1, 100)) + [-1000, 10000]
    df = spark.createDataFrame([(float(v), float(v)) for v in values],
                               "DISTANCE double, NON_OUTLIER double")
    out = cleaning.cap_outliers(df, ["DISTANCE"]).collect()
    lo, hi = np.percentile(values, [1, 99])
    capped = [r.DISTANCE for r in out]
    assert min(capped) == pytest.approx(lo) and max(capped) == pytest.approx(hi)
    assert sorted(r.NON_OUTLIER for r in out) == sorted(float(v) for v in values)


def test_drop_residual_nulls_allows_cancellation_reason(spark):
    df = spark.createDataFrame([(1, None), (2, "A"), (None, None)],
                               "a int, CANCELLATION_REASON string")
    assert cleaning.drop_residual_nulls(df).count() == 2


def test_cleaning_summary_counts(spark):
    before = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    after = before.dropna().drop("b")
    s = cleaning.cleaning_summary(before, after).first()
    assert (s.rows_before, s.columns_before, s.missing_cells_before) == (2, 2, 1)
    assert (s.rows_after, s.columns_after, s.rows_dropped, s.columns_dropped) == (1, 1, 1, 1)
