from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.operators import sampling as SA


def _df(spark, sizes):
    rows = [(f"id{s}-{i}", f"s{s}") for s, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "row_id string, grp string")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=4))
def test_bucketed_rank_equals_plain_window(spark, sizes):
    df = _df(spark, sizes)
    got = SA.rank_in_strata(df, ["grp"], salt="t", digits=1)
    want = df.withColumn("w", F.row_number().over(
        Window.partitionBy("grp").orderBy(SA.order_key("row_id", P.RANDOM_STATE, "t"), "row_id")))
    joined = got.join(want, "row_id").filter(F.col("__rank") != F.col("w"))
    assert joined.count() == 0


def test_sample_sizes_are_exact(spark):
    df = _df(spark, [125, 75, 1, 50])
    out = SA.stratified_sample(df, ["grp"], 0.02)
    counts = {r.grp: r["count"] for r in out.groupBy("grp").count().collect()}
    # round half to even: 2.5 -> 2, 1.5 -> 2, 0.02 -> 0, 1.0 -> 1
    assert counts == {"s0": 2, "s1": 2, "s3": 1}


def test_split_has_no_overlap_and_right_sizes(spark):
    rows = [(f"r{i}", "on_time" if i < 80 else "cancelled" if i < 81 else "minor_delay")
            for i in range(100)]
    df = spark.createDataFrame(rows, f"row_id string, {P.TARGET} string")
    train, test = SA.split_dataset(df, test_size=0.2)
    tr, te = {r.row_id for r in train.collect()}, {r.row_id for r in test.collect()}
    assert not tr & te and len(tr | te) == 100
    by = {r[P.TARGET]: r["count"] for r in test.groupBy(P.TARGET).count().collect()}
    assert by == {"on_time": 16, "minor_delay": 4}     # one-row class stays in train


def test_folds_are_stratified(spark):
    rows = [(f"r{i}", "a" if i % 2 else "b") for i in range(40)]
    df = spark.createDataFrame(rows, f"row_id string, {P.TARGET} string")
    out = SA.assign_folds(df)
    assert SA.n_folds(40, 2) == 5
    counts = out.groupBy("fold", P.TARGET).count().collect()
    assert all(r["count"] == 4 for r in counts) and len(counts) == 10
