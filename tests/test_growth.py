"""Steps that large tables need: no row repeated for each column, no input worked out twice."""

from pyspark.sql import functions as F

from pushback.operators import explore, features, quality, sampling
from pushback.operators.joins import keyed_stats
from pushback.sources import fixture

SF = "/root/testdata/sf0.001"


def test_profile_groups_each_column_by_itself(spark):
    df = spark.createDataFrame([(0.0, "b", 3), (-0.0, "a", 20), (1.5, None, 100), (1.5, "a", None)],
                               "x double, s string, k int")
    out = explore.dataset_profile(df)
    got = {r["column_name"]: (r["non_null"], r["distinct"], r["samples"]) for r in out.collect()}
    assert got == {"x": (4, 3, "-0.000000, 0.000000, 1.500000"), "s": (3, 2, "a, b"), "k": (3, 3, "3, 20, 100")}
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()


def test_repeats_shuffle_hashes_only(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (None, 1, 0.0), (2, 2, 1.0), (2, 2, 1.0), (2, 2, 1.0)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    r = quality.duplicates(df, ["a", "b"]).first()
    assert (r["full_row_duplicates"], r["flight_level_duplicates"]) == (3, 3)
    assert quality.duplicates(df.limit(0), ["a"]).first()["full_row_duplicates"] == 0
    wide = [f for f in df.columns]
    plan = quality._repeats(df, wide)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # rows are grouped whole only where their hash is shared


def test_sample_works_its_input_out_twice_and_no_more(spark):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("cast(id as string) as row_id", "cast(id % 3 as int) as MONTH")
    out = sampling.stratified_sample(df.mapInArrow(watch, df.schema), ["MONTH"], 0.1)
    assert sorted(r["n"] for r in out.groupBy("MONTH").agg(F.count(F.lit(1)).alias("n")).collect()) == [33, 33, 33]
    assert seen.value <= 2000


def test_key_statistics_add_up_equal_rows_first(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 0.0), ("a", None, 1.0), (None, 1, 1.0)], "p string, q int, y double")
    stats, small = keyed_stats(df, ["p", "q"], "n", ["y"])
    got = {(r["__key"], r["__value"]): (r["n"], r["y"]) for r in stats.collect()}
    assert got == {("p", "a"): (3, 2.0), ("q", "1"): (3, 2.0)}
    assert small == {"p": True, "q": True}


def test_flights_are_dealt_out_whatever_the_row_groups(spark):
    out = fixture.flights(spark, SF)
    assert "RebalancePartitions" in out._jdf.queryExecution().optimizedPlan().toString()


def test_rate_joins_move_each_row_as_one_struct(spark):
    train = spark.createDataFrame([("a", "AA", 1.0, "on_time"), ("b", "AA", 2.0, "major_delay"), ("c", None, 3.0, None)],
                                  "row_id string, AIRLINE string, other double, DELAY_CATEGORY string")
    tr, te = features.add_smoothed_rates(train, train.drop("DELAY_CATEGORY"), {"AIRLINE": "airline"}, drop=["AIRLINE"])
    assert tr.columns[:3] == ["row_id", "other", "DELAY_CATEGORY"] and "AIRLINE" not in te.columns
    got = {r["row_id"]: r for r in tr.collect()}
    assert (got["a"]["other"], got["c"]["other"]) == (1.0, 3.0)
    prior = got["c"]["airline_historical_on_time_rate"]  # no key: the share of all labelled rows
    assert prior == 0.5 and got["a"]["airline_historical_on_time_rate"] < prior < got["b"]["airline_historical_on_time_rate"]
    assert "__row#" in tr._jdf.queryExecution().optimizedPlan().toString()


def _keyed(spark):
    schema = "row_id string, AIRLINE string, ORIGIN_AIRPORT string, other double, DELAY_CATEGORY string"
    rows = [("a", "AA", "X", 1.0, "on_time"), ("b", "AA", "Y", None, "major_delay"), ("c", None, "X", 3.0, "cancelled"),
            ("d", "UA", None, 4.0, None), ("e", "UA", "X", 5.0, "no class"), ("f", "UA", "X", 5.0, "minor_delay")]
    test = [("t", "AA", None, 1.0, "on_time"), ("u", "ZZ", "X", 2.0, None)]
    return spark.createDataFrame(rows, schema), spark.createDataFrame(test, schema)


def test_statistics_of_small_keys_take_no_join(spark):
    train, test = _keyed(spark)
    for df in (*features.add_smoothed_rates(train, test, {"AIRLINE": "airline", "ORIGIN_AIRPORT": "origin"}),
               *features.add_frequency_encoding(train, test, ["AIRLINE", "ORIGIN_AIRPORT"])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "MapInArrow" in plan


def test_looked_up_and_joined_statistics_agree(spark, monkeypatch):
    train, test = _keyed(spark)
    keys = {"AIRLINE": "airline", "ORIGIN_AIRPORT": "origin"}

    def both():
        frames = (*features.add_smoothed_rates(train, test, keys), *features.add_frequency_encoding(train, test, list(keys)))
        return [(df.columns, sorted(tuple(map(str, r)) for r in df.collect())) for df in frames]

    looked_up = both()
    monkeypatch.setattr(features, "_held", lambda *_, **__: {})
    assert both() == looked_up
    rates = {r["row_id"]: r for r in features.add_smoothed_rates(train, test, keys)[0].collect()}
    prior = rates["c"]["airline_historical_on_time_rate"]
    assert prior == rates["d"]["airline_historical_on_time_rate"] == rates["e"]["airline_historical_on_time_rate"] == 0.2
    assert rates["f"]["airline_historical_on_time_rate"] == (0.0 + 25 * prior) / (3 - 1 + 25)


def test_feature_matrix_works_features_out_once_and_writes_none(spark):
    from pushback.plans import catalog

    catalog.forget_stages()
    out = catalog.feature_matrix(spark, SF)
    assert not [f for f in out.inputFiles() if "_features-" in f or "_matrix-" in f]
    assert out.count() == catalog.cleaned(spark, SF).count()
    catalog.forget_stages()
