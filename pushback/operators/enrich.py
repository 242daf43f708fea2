"""Time-zone-aware weather enrichment (B1-B5, C1-C3) and the enrichment job (H1).

Weather rows are keyed by Eastern wall-clock (month, day, hour); each flight
converts its local departure / arrival hour to Eastern time and left-joins.
The weather is written and measured once; within the limits it is broadcast, so
no flight is moved for it. Beyond them both joins are sort-merge joins on
(airport, month, day, hour): hour-level keys spread even a hub airport over
many partitions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.functions.exprs import (arrival_day, hour_of_hhmm, local_hour_ts,
                                      to_eastern)
from pushback.operators.joins import MAX_NARROW_ROWS, broadcast_if_small
from pushback.session import cut_lineage

TIME_KEYS = ("month", "day", "hour")


def add_hours(df: DataFrame, departure: str = "SCHEDULED_DEPARTURE",
              arrival: str = "SCHEDULED_ARRIVAL") -> DataFrame:
    """B1: departure_hour and scheduled_arrival_hour from HHMM."""
    return (df.withColumn("departure_hour", hour_of_hhmm(departure))
              .withColumn("scheduled_arrival_hour", hour_of_hhmm(arrival)))


def airport_time_zones(airports: DataFrame, code: str = "IATA_CODE", tz: str = "TZ",
                       lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """One zone per airport with coordinates (airports without them get no zone)."""
    return (airports.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
                    .groupBy(code).agg(F.max(tz).alias("tz")))


def _with_zone(df: DataFrame, zones: DataFrame, airport: str, out: str,
               default: str = P.EASTERN_TZ) -> DataFrame:
    """Zone of the airport, defaulting to Eastern when unknown."""
    z = zones.select(F.col("IATA_CODE").alias("_tz_code"), F.col("tz").alias("_tz"))
    joined = df.join(z, df[airport] == z["_tz_code"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_tz"), F.lit(default))).drop("_tz_code", "_tz")


def eastern_keys(df: DataFrame, prefix: str, ts, tz_col: str) -> DataFrame:
    """Eastern (month, day, hour) of a local timestamp; the year is dropped."""
    e = F.col("_e")  # a column of its own: converted once a row, not once a key
    return (df.withColumn("_local", ts).withColumn("_e", to_eastern(F.col("_local"), F.col(tz_col)))
              .withColumn(f"{prefix}month", F.month(e).cast("int"))
              .withColumn(f"{prefix}day", F.dayofmonth(e).cast("int"))
              .withColumn(f"{prefix}hour", F.hour(e).cast("int")).drop("_local", "_e"))


def _join_weather(df: DataFrame, weather: DataFrame, airport: str, key_prefix: str,
                  field_prefix: str, fields: Sequence[str], time_keys: Sequence[str]
                  ) -> DataFrame:
    w = weather.select(F.col("station").alias(f"{key_prefix}station"),
                       *[F.col(k).alias(f"{key_prefix}w{k}") for k in time_keys],
                       *[F.col(f).alias(field_prefix + f) for f in fields])
    cond = df[airport] == w[f"{key_prefix}station"]
    for k in time_keys:
        cond = cond & (df[f"{key_prefix}{k}"] == w[f"{key_prefix}w{k}"])
    drop = [f"{key_prefix}station"] + [f"{key_prefix}w{k}" for k in time_keys]
    return df.join(w, cond, "left").drop(*drop)


def merge_weather(flights: DataFrame, weather: DataFrame, airports: DataFrame,
                  fields: Sequence[str] = P.WEATHER_FIELDS,
                  time_keys: Sequence[str] = TIME_KEYS,
                  origin: str = "ORIGIN_AIRPORT", dest: str = "DESTINATION_AIRPORT",
                  year: str = "YEAR", month: str = "MONTH", day: str = "DAY",
                  scheduled_time: str = "SCHEDULED_TIME") -> DataFrame:
    """H1: hours, zones, Eastern keys, then origin and destination weather (left joins).

    ``weather``: (station, month, day, hour, fields...) unique per key.
    ``airports``: (IATA_CODE, LATITUDE, LONGITUDE, TZ).
    ``time_keys`` names the weather key parts to match (the year is never one).
    """
    zones = broadcast_if_small(airport_time_zones(airports))
    df = add_hours(flights)
    df = _with_zone(df, zones, origin, "_otz")
    df = _with_zone(df, zones, dest, "_dtz")

    origin_ts = local_hour_ts(year, month, day, "departure_hour")
    df = eastern_keys(df, "_o_", origin_ts, "_otz")

    arr_day = arrival_day(day, "departure_hour", scheduled_time)
    dest_ts = F.coalesce(local_hour_ts(year, month, arr_day, "scheduled_arrival_hour"),
                         local_hour_ts(year, month, day, "scheduled_arrival_hour"))
    df = eastern_keys(df, "_d_", dest_ts, "_dtz")

    weather = broadcast_if_small(cut_lineage(weather, "weather"), MAX_NARROW_ROWS)
    df = _join_weather(df, weather, origin, "_o_", "", fields, time_keys)
    df = _join_weather(df, weather, dest, "_d_", P.DEST_PREFIX, fields, time_keys)
    helper = ["_otz", "_dtz"] + [f"{p}{k}" for p in ("_o_", "_d_") for k in TIME_KEYS]
    return df.drop(*helper)


def join_coverage(before: DataFrame, after: DataFrame,
                  fields: Sequence[str] = P.WEATHER_FIELDS) -> DataFrame:
    """Rows before/after and rows missing any origin / destination field."""
    def any_null(prefix):
        cond = F.lit(False)
        for f in fields:
            cond = cond | F.col(prefix + f).isNull()
        return cond

    n_before = before.agg(F.count(F.lit(1)).alias("n"))
    stats = after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(any_null("")).alias("missing_origin_weather"),
        F.count_if(any_null(P.DEST_PREFIX)).alias("missing_dest_weather"))
    combined = (n_before.select(F.col("n").alias("rows_before"),
                                F.lit(None).cast("bigint").alias("rows_after"),
                                F.lit(None).cast("bigint").alias("missing_origin_weather"),
                                F.lit(None).cast("bigint").alias("missing_dest_weather"))
                .unionByName(stats.withColumn("rows_before", F.lit(None).cast("bigint"))))
    out = combined.agg(*[F.max(c).alias(c) for c in
                         ["rows_before", "rows_after", "missing_origin_weather",
                          "missing_dest_weather"]])
    return out.select(
        "rows_before", "rows_after", "missing_origin_weather", "missing_dest_weather",
        F.round(F.col("missing_origin_weather") * 100 / F.col("rows_after"), 2)
        .alias("missing_origin_pct"),
        F.round(F.col("missing_dest_weather") * 100 / F.col("rows_after"), 2)
        .alias("missing_dest_pct"))
