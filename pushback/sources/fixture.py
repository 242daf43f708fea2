"""Flight-shaped and weather-shaped views over the driver tables.

The driver tables hold no flights, so the flight table is a view over
``lineitem ⋈ orders ⋈ customer ⋈ supplier`` and hourly weather is an
aggregate of ``events``. Keys, times and labels use integer arithmetic only,
so an independent SQL engine reproduces every row (see ``pushback.oracle``).
The delay is a formula of the keys: model scores on it carry no meaning, the
view exists to exercise operators at every scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback import profile as P
from pushback.functions.exprs import hhmm_of_minutes
from pushback.operators.joins import MAX_NARROW_ROWS, broadcast_if_small
from pushback.sources.tables import read_table

# fixture values: region number -> time zone of its airports
REGION_TIME_ZONES = ["America/New_York", "America/Chicago", "America/Denver",
                     "America/Los_Angeles", "Pacific/Honolulu"]
NATION_WITHOUT_COORDS = 23  # its airport has no coordinates
STATION_NOT_LOADED = 21     # the gap that the search for stations to load finds
LAST_DAY_EVERY = 97         # every 97th part number leaves on a 31st, of whatever month
NEGATIVE_EVERY = 89         # every 89th has a distance out of range
NUMERIC_DEST_EVERY = 50     # every 50th part number flies to a numeric FAA id


def airport_code(nationkey: Column) -> Column:
    """Airport code of a nation: 'N' + letter + 'X'; nation 24 breaks the format."""
    k = nationkey.cast("int")
    return F.when(k == 24, F.lit("n24")).otherwise(
        F.concat(F.lit("N"), F.chr(k + 65), F.lit("X")))


def _row_id() -> Column:
    """md5 of all lineitem columns; unique where (orderkey, linenumber) is not.

    Doubles enter as floor(x * 100 + 0.5) and the date as yyyymmdd, which both
    engines compute exactly.
    """
    c = F.col

    def cents(name: str) -> Column:
        return F.floor(c(name) * 100 + 0.5)

    ymd = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.dayofmonth("l_shipdate")
    parts = [c("l_orderkey"), c("l_partkey"), c("l_suppkey"), c("l_linenumber"),
             F.floor(c("l_quantity")), cents("l_extendedprice"), cents("l_discount"),
             cents("l_tax"), c("l_returnflag"), c("l_linestatus"), ymd]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """31 BTS-shaped columns plus ``row_id``, one row per lineitem row."""
    l = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # customers meet the orders, not their many lines, which are moved once
    oc = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderstatus", "c_nationkey",
                                                                   "c_mktsegment")
    base = (l.join(broadcast_if_small(s, MAX_NARROW_ROWS), F.col("l_suppkey") == F.col("s_suppkey"))
             .join(oc, F.col("l_orderkey") == F.col("o_orderkey")))
    # a file of few row groups is read by as few tasks, which would then do all the work on its
    # rows; dealt out while they are narrow (with these columns AQE splits a hot key's rows too)
    base = base.hint("rebalance", "l_orderkey", "l_linenumber")

    c = F.col
    # step 1: shared intermediates, computed once per row
    cancelled = (c("o_orderstatus") == "P") & (c("l_returnflag") == "R") & (c("l_linenumber") == 1)
    sched_time = F.lit(40) + c("l_quantity") * 8
    air_time = sched_time - 10 + c("l_suppkey") % 7
    taxi_out = F.lit(5) + c("l_orderkey") % 25
    taxi_in = F.lit(3) + c("l_partkey") % 12
    step1 = base.select(
        _row_id().alias("row_id"), "l_shipdate", "l_orderkey", "l_partkey", "l_suppkey",
        "l_linenumber", "l_extendedprice", "c_mktsegment", "c_nationkey", "s_nationkey",
        cancelled.alias("_cx"),
        (~cancelled & (c("l_partkey") % 97 == 0)).alias("_dv"),
        (((c("l_orderkey") + c("l_linenumber")) % 24) * 60 + c("l_partkey") % 60).alias("_dep_min"),
        sched_time.alias("_sched"),
        ((c("l_partkey") * 31 + c("l_suppkey") * 17 + c("l_linenumber")) % 140 - 70).alias("_delay"),
        taxi_out.alias("_taxi_out"), taxi_in.alias("_taxi_in"), air_time.alias("_air"),
        (taxi_out + air_time + taxi_in
         + F.when(c("l_orderkey") % 101 == 0, 9).otherwise(0)).alias("_elapsed"))
    # step 2: times built on the intermediates
    step2 = step1.select(
        "*",
        (c("_dep_min") + c("_delay")).alias("_act_dep"),
        (c("_delay") + c("_elapsed") - c("_sched")).alias("_arr_delay"),
        (c("_cx") | c("_dv")).alias("_gone"))
    step3 = step2.select(
        "*", (c("_act_dep") + c("_taxi_out")).alias("_off"))
    step4 = step3.select(
        "*", (c("_off") + c("_air").cast("bigint")).alias("_on"))

    def none_if(cond: Column, value: Column, dtype: str) -> Column:
        return F.when(cond, F.lit(None).cast(dtype)).otherwise(value.cast(dtype))

    gone, cx = c("_gone"), c("_cx")
    arr_delay = c("_arr_delay")
    air_sys = (c("l_orderkey") % 3) * 5
    weather_d = (c("l_partkey") % 4) * 2
    late_ac = (c("l_suppkey") % 5) * 3

    def breakdown(value: Column) -> Column:
        return F.when(~gone & (arr_delay >= 15), value.cast("double"))

    return step4.select(
        "row_id",
        F.year("l_shipdate").cast("int").alias("YEAR"),
        F.month("l_shipdate").cast("int").alias("MONTH"),
        F.when(c("l_partkey") % LAST_DAY_EVERY == 0, 31)
         .otherwise(F.dayofmonth("l_shipdate")).cast("int").alias("DAY"),
        (F.weekday("l_shipdate") + 1).cast("int").alias("DAY_OF_WEEK"),
        c("c_mktsegment").alias("AIRLINE"),
        c("l_partkey").alias("FLIGHT_NUMBER"),
        c("l_suppkey").cast("string").alias("TAIL_NUMBER"),
        airport_code(c("s_nationkey")).alias("ORIGIN_AIRPORT"),
        F.when(c("l_partkey") % NUMERIC_DEST_EVERY == 0, (c("c_nationkey") + 10000).cast("string"))
         .otherwise(airport_code(c("c_nationkey"))).alias("DESTINATION_AIRPORT"),
        (((c("l_orderkey") + c("l_linenumber")) % 24) * 100
         + c("l_partkey") % 60).cast("int").alias("SCHEDULED_DEPARTURE"),
        F.when(cx & (c("l_partkey") % 7 != 0), F.lit(None).cast("int"))
         .otherwise(hhmm_of_minutes(c("_act_dep"))).alias("DEPARTURE_TIME"),
        none_if(cx, c("_delay"), "double").alias("DEPARTURE_DELAY"),
        none_if(cx, c("_taxi_out"), "double").alias("TAXI_OUT"),
        none_if(cx, hhmm_of_minutes(c("_off")), "int").alias("WHEELS_OFF"),
        c("_sched").cast("double").alias("SCHEDULED_TIME"),
        none_if(gone, c("_elapsed"), "double").alias("ELAPSED_TIME"),
        none_if(gone, c("_air"), "double").alias("AIR_TIME"),
        (F.when(c("l_partkey") % NEGATIVE_EVERY == 0, -c("l_extendedprice"))
         .otherwise(c("l_extendedprice")) / 100).alias("DISTANCE"),
        none_if(gone, hhmm_of_minutes(c("_on")), "int").alias("WHEELS_ON"),
        none_if(gone, c("_taxi_in"), "double").alias("TAXI_IN"),
        hhmm_of_minutes(c("_dep_min") + c("_sched").cast("bigint")).alias("SCHEDULED_ARRIVAL"),
        none_if(gone, hhmm_of_minutes(c("_on") + c("_taxi_in")), "int").alias("ARRIVAL_TIME"),
        none_if(gone, arr_delay, "double").alias("ARRIVAL_DELAY"),
        c("_dv").cast("int").alias("DIVERTED"),
        cx.cast("int").alias("CANCELLED"),
        F.when(cx, F.chr((c("l_orderkey") % 4 + 65).cast("int"))).alias("CANCELLATION_REASON"),
        breakdown(air_sys).alias("AIR_SYSTEM_DELAY"),
        breakdown(F.lit(0)).alias("SECURITY_DELAY"),
        breakdown(arr_delay - air_sys - weather_d - late_ac).alias("AIRLINE_DELAY"),
        breakdown(late_ac).alias("LATE_AIRCRAFT_DELAY"),
        breakdown(weather_d).alias("WEATHER_DELAY"),
    )


def _value_of(event_type: str, scale: float) -> Column:
    return F.sum(F.when(F.col("event_type") == event_type, F.col("value"))) / scale


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather per station from ``events``: (station, month, day, hour, 11 fields).

    Station = airport of nation ``user_id % 25``. Times are Eastern wall-clock hours.
    The events of a user's residue modulo 4 at an hour make the weather of that
    hour on every fourth day (1 to 28) of each month.
    """
    e = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    grouped = (e.groupBy(airport_code((F.col("user_id") % 25).cast("int")).alias("station"),
                         (F.col("user_id") % 4).cast("int").alias("residue"),
                         F.hour("ts").cast("int").alias("hour")))
    observed = grouped.agg(
        F.round(F.avg("value") / 10 - 5, 6).alias("temperature_c"),
        F.round(F.coalesce(_value_of("click", 20.0), F.lit(0.0)), 6).alias("precipitation_mm"),
        F.round(F.coalesce(_value_of("purchase", 25.0), F.lit(0.0)), 6).alias("rain_mm"),
        F.round(F.coalesce(F.sum(F.when((F.col("event_type") == "signup")
                                        & (F.col("value") > 300), F.col("value"))) / 50,
                           F.lit(0.0)), 6).alias("snowfall_cm"),
        F.round(F.max("value") / 5, 6).alias("wind_speed_kmh"),
        F.round(F.min(k) * 3.6, 6).alias("wind_direction_deg"),
        F.round(F.max("value") / 4, 6).alias("wind_gusts_kmh"),
        F.least(F.count(F.lit(1)) * 10, F.lit(100)).cast("double").alias("cloud_cover_pct"),
        F.count_distinct("event_type").cast("double").alias("weather_code"),
        F.round(F.avg(k), 6).alias("relative_humidity_pct"),
        F.round(F.avg("value") / 5 + 1000, 6).alias("pressure_msl_hpa"),
    )
    spread = (observed.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
              .withColumn("week", F.explode(F.sequence(F.lit(1), F.lit(7)))))
    return spread.select("station", "month", (F.col("week") * 4 - F.col("residue")).alias("day"), "hour",
                         *P.WEATHER_FIELDS)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension (IATA_CODE, LATITUDE, LONGITUDE, TZ) from ``nation``.

    One nation has no coordinates, so its zone is unknown and its weather is
    never fetched. Flights to numeric ids go to airports that are not listed.
    """
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    tz = F.element_at(F.array(*[F.lit(z) for z in REGION_TIME_ZONES]),
                      (F.col("n_regionkey") % len(REGION_TIME_ZONES) + 1).cast("int"))
    no_coords = F.col("n_nationkey") == NATION_WITHOUT_COORDS
    return n.select(
        airport_code(F.col("n_nationkey")).alias("IATA_CODE"),
        F.when(~no_coords, (F.col("n_nationkey") + 25).cast("double")).alias("LATITUDE"),
        F.when(~no_coords, (F.col("n_nationkey") * -2 - 70).cast("double")).alias("LONGITUDE"),
        F.when(~no_coords, tz).alias("TZ"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline dimension: the market segments."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_mktsegment").alias("IATA_CODE")).distinct()
