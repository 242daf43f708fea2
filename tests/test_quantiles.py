import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from pushback.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("accuracy", [10, 100_000])
def test_exact_quantiles_match_numpy_linear(spark, accuracy):
    rng = np.random.default_rng(7)
    a = rng.normal(size=700).round(2)          # many ties after rounding
    b = rng.integers(0, 5, size=700).astype(float)
    rows = [(float(x), float(y), i % 3) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, g int")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["g"], r["column"], r["prob"]): r["value"]
           for r in exact_quantiles(df, ["a", "b"], probs, ["g"], accuracy=accuracy).collect()}
    for g in range(3):
        for col, arr in (("a", a), ("b", b)):
            vals = arr[[i % 3 == g for i in range(len(arr))]]
            for p in probs:
                assert got[(g, col, p)] == pytest.approx(np.percentile(vals, p * 100))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=120), st.floats(0, 1))
def test_exact_quantiles_property(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    r = exact_quantiles(df, ["x"], [p], accuracy=8).first()
    assert r["value"] == pytest.approx(np.percentile(values, p * 100))


def test_ties_and_sizes_follow_one_rule(spark):
    """90 % equal values, sizes on both sides of the accuracy, groups and specials."""
    import duckdb
    import numpy as np
    rng = np.random.default_rng(5)
    n = 450_000
    a = np.where(rng.random(n) < 0.9, 0.0, rng.normal(size=n))
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "a": a, "b": np.round(rng.gamma(2, 3, n), 2)})
    small = pdf.head(37).assign(g=9)
    pdf = pd.concat([pdf, small, pdf.head(1).assign(g=10)], ignore_index=True)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    df = spark.createDataFrame(pdf)
    got = {(r["g"], r["column"], r["prob"]): r["value"]
           for r in exact_quantiles(df, ["a", "b"], probs, ["g"]).collect()}
    con = duckdb.connect()
    con.register("t", pdf)
    for c in ("a", "b"):
        for g, *values in con.sql(f"SELECT g, {', '.join(f'quantile_cont({c}, {p})' for p in probs)} FROM t GROUP BY g").fetchall():
            for p, v in zip(probs, values):
                assert abs(got[(g, c, p)] - v) < 1e-9, (g, c, p)


def test_plan_moves_no_rows_by_column(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as double) as a", "cast(id % 7 as double) as b")
    plan = exact_quantiles(df, ["a", "b"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_one_row_a_cell_is_never_built(spark):
    """Values are counted by digits in Arrow batches: no row for each cell, no sketch; specials sort as they should."""
    values = [float("-inf"), -1e300, -2.5, -0.0, 0.0, 5e-324, 2.5, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v, "a" if i % 2 else None) for i, v in enumerate(values)], "x double, g string")
    got = [r["value"] for r in exact_quantiles(df, ["x"], [i / 8 for i in range(9)], accuracy=1).orderBy("prob").collect()]
    assert got == sorted(v for v in values if v is not None and v == v)
    assert {r["g"]: r["n"] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()} == {"a": 4}
    assert exact_quantiles(df.filter("x > 1e308 and x < 1"), ["x"], [0.5], ["g"]).collect() == []
    from pushback.operators import quantiles
    assert not hasattr(quantiles, "_cells")
