"""Hourly weather payloads: JSON parallel arrays to long rows (A4, A5).

A payload is ``{"hourly": {"time": [...], "temperature_2m": [...], ...}}``
per station and year. ``arrays_zip`` + ``posexplode`` turn it into one row per
hour; a repeated (month, day, hour) keeps the last array position, chosen by
``max_by`` in an aggregate (a group holds at most two positions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback import profile as P

API_FIELDS = list(P.WEATHER_API_FIELDS)
# station code from a file name ``{IATA}_{YEAR}.json`` or a ``station=`` folder
STATION_FROM_PATH = r"(?:station=([^/]+)/[^/]*$)|(?:([^/_]+)_[0-9]{4}\.json$)"


def payload_schema() -> T.StructType:
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(f, T.ArrayType(T.DoubleType())) for f in API_FIELDS]
    return T.StructType([T.StructField("hourly", T.StructType(arrays))])


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """A4 source: (station, hourly) from JSON files; station from the path."""
    raw = spark.read.schema(payload_schema()).option("multiLine", True).json(path)
    fname = F.input_file_name()
    station = F.coalesce(F.nullif(F.regexp_extract(fname, STATION_FROM_PATH, 1), F.lit("")),
                         F.regexp_extract(fname, STATION_FROM_PATH, 2))
    return raw.select(station.alias("station"), "hourly")


def flatten_hourly(payloads: DataFrame) -> DataFrame:
    """A4: (station, month, day, hour, 11 renamed fields), last position wins."""
    zipped = F.arrays_zip(*[F.col(f"hourly.{f}").alias(f) for f in ["time"] + API_FIELDS])
    rows = payloads.select("station", F.posexplode(zipped).alias("pos", "h"))
    t = F.col("h.time")
    keyed = rows.select(
        "station", "pos",
        F.substring(t, 6, 2).cast("int").alias("month"),
        F.substring(t, 9, 2).cast("int").alias("day"),
        F.substring(t, 12, 2).cast("int").alias("hour"),
        F.struct(*[F.col(f"h.{api}").alias(name) for api, name in P.WEATHER_API_FIELDS.items()])
        .alias("w"))
    last = keyed.groupBy("station", "month", "day", "hour").agg(F.max_by("w", "pos").alias("w"))
    return last.select("station", "month", "day", "hour", "w.*")


def payloads_from_hourly(hourly: DataFrame, year: int) -> DataFrame:
    """Inverse of ``flatten_hourly`` (tests / fixtures): one payload per station-year.

    A group is one station's hours of one year (at most 8,784 entries — the
    payload's own size), sorted by time.
    """
    time = F.format_string("%04d-%02d-%02dT%02d:00", F.lit(year), "month", "day", "hour")
    item = F.struct(time.alias("time"), *[F.col(name).alias(api)
                                          for api, name in P.WEATHER_API_FIELDS.items()])
    grouped = hourly.groupBy("station").agg(F.array_sort(F.collect_list(item)).alias("items"))
    def field_of(name):
        return lambda x: x[name]

    arrays = [F.transform("items", field_of(f)).alias(f) for f in ["time"] + API_FIELDS]
    return grouped.select("station", F.struct(*arrays).alias("hourly"))


def stations_to_load(flights: DataFrame, airports: DataFrame, loaded: DataFrame,
                     origin: str = "ORIGIN_AIRPORT", dest: str = "DESTINATION_AIRPORT"
                     ) -> DataFrame:
    """A5 + F8: airports used by flights (origin ∪ destination), with coordinates,
    whose weather is not stored yet; airports without coordinates are skipped."""
    used = (flights.select(F.col(origin).alias("station"))
                   .union(flights.select(F.col(dest).alias("station")))
                   .dropna().distinct())
    with_coords = (airports.filter(F.col("LATITUDE").isNotNull() & F.col("LONGITUDE").isNotNull())
                           .select(F.col("IATA_CODE").alias("station")))
    done = loaded.select("station").distinct()
    return used.join(with_coords, "station", "left_semi").join(done, "station", "left_anti")
