import datetime as dt

from pyspark.sql import functions as F

from pushback.functions.exprs import arrival_day, local_hour_ts, to_eastern
from pushback.operators import enrich


def _east(spark, y, m, d, h, tz):
    df = spark.createDataFrame([(y, m, d, h, tz)], "y int, m int, d int, h int, tz string")
    return df.select(to_eastern(local_hour_ts("y", "m", "d", "h"), F.col("tz")).alias("e")).first().e


def test_time_zone_rules(spark):
    # Chicago 01:00 on the spring-forward day is 03:00 Eastern
    assert _east(spark, 2015, 3, 8, 1, "America/Chicago") == dt.datetime(2015, 3, 8, 3)
    # ambiguous fall-back hour takes the earlier (daylight) offset: 06:00 UTC = 01:00 EST
    assert _east(spark, 2015, 11, 1, 1, "America/Chicago") == dt.datetime(2015, 11, 1, 1)
    # a local time in the DST gap is read with the offset before the change
    assert _east(spark, 2015, 3, 8, 2, "America/Chicago") == dt.datetime(2015, 3, 8, 4)
    # same zone is returned unchanged, even in the DST gap
    assert _east(spark, 2015, 3, 8, 2, "America/New_York") == dt.datetime(2015, 3, 8, 2)
    # Honolulu late on 31 Dec is next year's 1 Jan in Eastern time
    assert _east(spark, 2015, 12, 31, 22, "Pacific/Honolulu") == dt.datetime(2016, 1, 1, 3)
    # impossible dates give NULL instead of raising
    assert _east(spark, 2015, 2, 30, 1, "America/Chicago") is None


def test_arrival_day(spark):
    df = spark.createDataFrame([(10, 23, 120.0), (10, 5, None), (31, 22, 200.0)],
                               "d int, h int, t double")
    got = [r.a for r in df.select(arrival_day("d", "h", "t").alias("a")).collect()]
    assert got == [11, 10, 32]


def test_merge_weather_keeps_rows_and_matches(spark):
    flights = spark.createDataFrame([
        (2015, 1, 10, "AAA", "BBB", 1030, 1400, 150.0),
        (2015, 1, 10, "ZZZ", "BBB", 2330, 130, 90.0),
    ], "YEAR int, MONTH int, DAY int, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, "
       "SCHEDULED_DEPARTURE int, SCHEDULED_ARRIVAL int, SCHEDULED_TIME double")
    airports = spark.createDataFrame([("AAA", 1.0, 2.0, "America/Chicago"),
                                      ("BBB", 1.0, 2.0, "America/New_York")],
                                     "IATA_CODE string, LATITUDE double, LONGITUDE double, TZ string")
    weather = spark.createDataFrame([("AAA", 1, 10, 11, 5.0), ("BBB", 1, 10, 14, 7.0),
                                     ("BBB", 1, 11, 1, 9.0)],
                                    "station string, month int, day int, hour int, temperature_c double")
    out = enrich.merge_weather(flights, weather, airports, fields=["temperature_c"]).collect()
    assert len(out) == 2
    by = {r.ORIGIN_AIRPORT: r for r in out}
    assert by["AAA"].temperature_c == 5.0 and by["AAA"].dest_temperature_c == 7.0
    assert by["ZZZ"].temperature_c is None and by["ZZZ"].dest_temperature_c == 9.0
