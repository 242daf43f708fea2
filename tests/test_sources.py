import json

from pushback.operators import enrich
from pushback.sources import io, weather_json as WJ


def test_weather_payload_flatten_last_position_wins(spark, tmp_path):
    n = 4
    hourly = {"time": ["2015-11-01T01:00", "2015-11-01T01:00", "2015-11-01T02:00", "2015-11-01T03:00"]}
    for api in WJ.API_FIELDS:
        hourly[api] = [float(i) for i in range(n)]
    (tmp_path / "ATL_2015.json").write_text(json.dumps({"hourly": hourly}))
    rows = WJ.flatten_hourly(WJ.read_payloads(spark, str(tmp_path))).orderBy("hour").collect()
    assert [r.station for r in rows] == ["ATL"] * 3
    assert [(r.hour, r.temperature_c) for r in rows] == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_stations_to_load(spark):
    flights = spark.createDataFrame([("A", "B"), ("C", None), ("D", "123")],
                                    "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    airports = spark.createDataFrame([("A", 1.0, 1.0), ("B", 1.0, 1.0), ("C", None, 1.0),
                                      ("D", 1.0, 1.0)],
                                     "IATA_CODE string, LATITUDE double, LONGITUDE double")
    loaded = spark.createDataFrame([("A",)], "station string")
    got = {r.station for r in WJ.stations_to_load(flights, airports, loaded).collect()}
    assert got == {"B", "D"}


def test_airport_coords_scan(spark, tmp_path):
    p = tmp_path / "airports.csv"
    p.write_text("IATA_CODE,LATITUDE,LONGITUDE\nATL,33.6,-84.4\nXXX,,1\nATL,34.0,-84.0\n")
    rows = io.read_airport_coords(spark, str(p)).collect()
    assert [(r.IATA_CODE, r.LATITUDE) for r in rows] == [("ATL", 34.0)]
    zones = enrich.airport_time_zones(
        spark.createDataFrame([("ATL", 1.0, 2.0, "America/New_York"), ("X", None, 2.0, "UTC")],
                              "IATA_CODE string, LATITUDE double, LONGITUDE double, TZ string"))
    assert [r.IATA_CODE for r in zones.collect()] == ["ATL"]


def test_flights_csv_and_feature_artifacts(spark, tmp_path):
    header = ",".join(io.flights_schema().fieldNames())
    row = ",".join(["2015", "1", "1", "4", "AA", "98", "N1", "ATL", "14747"] + [""] * 22)
    (tmp_path / "f.csv").write_text(header + "\n" + row + "\n")
    f = io.read_flights_csv(spark, str(tmp_path / "f.csv")).first()
    assert f.DESTINATION_AIRPORT == "14747" and f.FLIGHT_NUMBER == 98 and f.DEPARTURE_DELAY is None
    tr = spark.createDataFrame([("a", 1.0)], "row_id string, x double")
    io.save_feature_artifacts(tr, tr, str(tmp_path / "feat"))
    a, b = io.load_feature_artifacts(spark, str(tmp_path / "feat"))
    assert a.count() == 1 and b.count() == 1 and "split" not in a.columns
