import math

import pytest

from pushback import profile as P
from pushback.functions.calendar import federal_holidays
from pushback.operators import features as FE


def _frames(spark):
    cols = ("YEAR int, MONTH int, DAY int, DAY_OF_WEEK int, SCHEDULED_DEPARTURE int, "
            "SCHEDULED_ARRIVAL int, temperature_c double, precipitation_mm double, rain_mm double, "
            "snowfall_cm double, wind_speed_kmh double, wind_gusts_kmh double, "
            "dest_temperature_c double, dest_precipitation_mm double, dest_rain_mm double, "
            "dest_snowfall_cm double, dest_wind_speed_kmh double, dest_wind_gusts_kmh double, "
            "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DIVERTED int, "
            "CANCELLATION_REASON string, DELAY_CATEGORY string, row_id string")
    train = spark.createDataFrame([
        (2015, 1, 1, 4, 530, 745, -2.0, 6.0, 6.0, 0.0, 10.0, 45.0, 15.0, 0.0, 0.0, 0.0, 12.0,
         20.0, "AA", "ATL", "LAX", 0, None, "on_time", "r0"),
        (2015, 7, 4, 6, 1845, 2105, 18.0, 0.0, 0.0, 0.0, 15.0, 18.0, -3.0, 3.0, 3.0, 1.0, 42.0,
         55.0, "DL", "JFK", "SFO", 0, None, "minor_delay", "r1")], cols)
    test = spark.createDataFrame([
        (2015, 11, 26, 4, 830, 1130, -5.0, 4.0, 4.0, 2.0, 35.0, 50.0, -1.0, 3.0, 3.0, 0.0, 10.0,
         25.0, "UA", "LAX", "SEA", 0, None, "major_delay", "t0")], cols)
    return train, test


def test_feature_matrix_values(spark):
    train, test = _frames(spark)
    tr, te = FE.build_feature_matrices(train, test)
    trr = {r.row_id: r for r in tr.collect()}
    t = te.first()
    assert sorted(tr.columns) == sorted(te.columns)
    for c in ["DIVERTED", "CANCELLATION_REASON", "AIRLINE", "ORIGIN_AIRPORT", "ROUTE"]:
        assert c not in tr.columns
    assert trr["r0"].is_holiday == 1 and trr["r1"].is_weekend == 1
    assert trr["r1"].is_evening_peak_bank == 1
    assert t.is_weekend == 0 and t.is_holiday == 1 and t.is_morning_peak_bank == 1
    assert t.scheduled_departure_hour_sin == pytest.approx(0.8660254038)
    assert t.scheduled_departure_hour_cos == pytest.approx(-0.5)
    assert trr["r0"].month_sin == pytest.approx(0.0) and trr["r0"].month_cos == pytest.approx(1.0)
    assert trr["r0"].origin_hourly_departure_count == 1
    assert trr["r1"].destination_hourly_arrival_count == 1
    assert t.origin_weather_intensity == 4.0 and t.destination_weather_intensity == 2.0
    assert t.origin_congestion_weather_score == pytest.approx(4.0)
    assert t.destination_congestion_weather_score == pytest.approx(2.0)
    assert t.route_congestion_weather_score == pytest.approx(12.0)
    assert t.airline_historical_on_time_rate == 0.5
    assert t.airline_historical_minor_delay_rate == 0.5
    assert t.airline_historical_major_delay_rate == 0.0
    assert t.airline_route_historical_on_time_rate == 0.5
    assert t.route_departure_bank_historical_minor_delay_rate == 0.5
    assert t.route_day_of_week_historical_major_delay_rate == 0.0
    assert t.route_historical_cancelled_rate == 0.0


def test_leave_one_out_rates(spark):
    train = spark.createDataFrame([("a", "AA", "on_time"), ("b", "AA", "major_delay"),
                                   ("c", "UA", "minor_delay")], "row_id string, AIRLINE string, DELAY_CATEGORY string")
    test = spark.createDataFrame([("x", "AA"), ("y", "UA"), ("z", "DL")], "row_id string, AIRLINE string")
    tr, te = FE.add_smoothed_rates(train, test, {"AIRLINE": "airline"})
    a = {r.row_id: r.airline_historical_on_time_rate for r in tr.collect()}
    b = {r.row_id: r.airline_historical_on_time_rate for r in te.collect()}
    assert a["a"] == pytest.approx(25 / 78) and a["b"] == pytest.approx(28 / 78)
    assert a["c"] == pytest.approx(1 / 3)
    assert b["x"] == pytest.approx(28 / 81) and b["y"] == pytest.approx(25 / 78)
    assert b["z"] == pytest.approx(1 / 3)


def test_null_key_falls_back_to_prior(spark):
    train = spark.createDataFrame([("a", None, "on_time"), ("b", "AA", "cancelled")],
                                  "row_id string, AIRLINE string, DELAY_CATEGORY string")
    tr, te = FE.add_smoothed_rates(train, train.drop(P.TARGET), {"AIRLINE": "airline"})
    r = {x.row_id: x.airline_historical_on_time_rate for x in tr.collect()}
    assert r["a"] == pytest.approx(0.5)


def test_mutual_information_selects_signal(spark):
    rows = [(f"r{i}", s, n, 1, y) for i, (s, n, y) in enumerate(zip(
        [0, 0, 0, 0, 1, 1, 1, 1], [0, 1, 0, 1, 0, 1, 0, 1],
        ["on_time"] * 4 + ["major_delay"] * 4))]
    schema = "row_id string, signal_feature int, weak_noise int, constant_feature int, DELAY_CATEGORY string"
    train = spark.createDataFrame(rows, schema)
    tr, te, chosen = FE.select_informative(train, train, method="mutual_info", min_mutual_info=0.2)
    assert chosen == ["signal_feature"]
    mi = {r.column: r.mutual_info for r in FE.mutual_information(
        train, ["signal_feature", "weak_noise"]).collect()}
    assert mi["signal_feature"] == pytest.approx(math.log(2))
    assert mi["weak_noise"] == pytest.approx(0.0, abs=1e-12)
    with pytest.raises(ValueError):
        FE.select_informative(train, train, method="chi2")


def test_adapt_for_mode(spark):
    df = spark.createDataFrame([(0.0, 0.2, 0.1)], "signal_feature double, "
                               "route_historical_on_time_rate double, airline_route_historical_major_delay_rate double")
    tr, te, dropped = FE.adapt_for_mode(df, df, "hist_gradient_boosting")
    assert tr.columns == ["signal_feature"] and dropped == [
        "route_historical_on_time_rate", "airline_route_historical_major_delay_rate"]
    tr, te, dropped = FE.adapt_for_mode(df, df, "logreg_balanced")
    assert tr.columns == df.columns and dropped == []


def test_federal_holidays_2015():
    got = [d.strftime("%m-%d") for d in federal_holidays(2015, 2015)]
    assert got == ["01-01", "01-19", "02-16", "05-25", "07-03", "09-07", "10-12", "11-11",
                   "11-26", "12-25"]
