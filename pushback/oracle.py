"""DuckDB SQL for the correctness gate.

Each registered query has an independent SQL text here, run by DuckDB on the
same parquet tables (views ``lineitem``, ``orders``, ... are pre-registered).
The fixture views are written once as CTE bodies and prepended with ``WITH``.
"""

from __future__ import annotations

from pushback import profile as P


def _code(k: str) -> str:
    return f"(CASE WHEN CAST({k} AS INTEGER) = 24 THEN 'n24' ELSE 'N' || chr(CAST({k} AS INTEGER) + 65) || 'X' END)"


def _hhmm(m: str) -> str:
    mm = f"((({m}) % 1440 + 1440) % 1440)"
    return f"CAST(({mm} // 60) * 100 + {mm} % 60 AS INTEGER)"


_DEP_MIN = "(((l_orderkey + l_linenumber) % 24) * 60 + l_partkey % 60)"
_SCHED = "(40 + l_quantity * 8)"
_DELAY = "((l_partkey * 31 + l_suppkey * 17 + l_linenumber) % 140 - 70)"
_TAXI_OUT = "(5 + l_orderkey % 25)"
_TAXI_IN = "(3 + l_partkey % 12)"
_AIR = f"({_SCHED} - 10 + l_suppkey % 7)"
_ELAPSED = f"({_TAXI_OUT} + {_AIR} + {_TAXI_IN} + CASE WHEN l_orderkey % 101 = 0 THEN 9 ELSE 0 END)"
_ACT_DEP = f"({_DEP_MIN} + {_DELAY})"
_OFF = f"({_ACT_DEP} + {_TAXI_OUT})"
_ON = f"({_OFF} + CAST({_AIR} AS BIGINT))"
_ARR = f"({_ON} + {_TAXI_IN})"
_ARR_DELAY = f"({_DELAY} + {_ELAPSED} - {_SCHED})"

FLIGHTS_BASE = f"""
  SELECT *,
    (o_orderstatus = 'P' AND l_returnflag = 'R' AND l_linenumber = 1) AS is_cancelled,
    (NOT (o_orderstatus = 'P' AND l_returnflag = 'R' AND l_linenumber = 1)
       AND l_partkey % 97 = 0) AS is_diverted
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
"""

FLIGHTS = f"""
  SELECT
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
        CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
        CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR),
        CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR),
        CAST(CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS VARCHAR),
        CAST(CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS VARCHAR),
        l_returnflag, l_linestatus,
        CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS VARCHAR))) AS row_id,
    CAST(year(l_shipdate) AS INTEGER) AS "YEAR",
    CAST(month(l_shipdate) AS INTEGER) AS "MONTH",
    CASE WHEN l_partkey % 97 = 0 THEN 31 ELSE CAST(day(l_shipdate) AS INTEGER) END AS "DAY",
    CAST(isodow(l_shipdate) AS INTEGER) AS DAY_OF_WEEK,
    c_mktsegment AS AIRLINE,
    l_partkey AS FLIGHT_NUMBER,
    CAST(l_suppkey AS VARCHAR) AS TAIL_NUMBER,
    {_code('s_nationkey')} AS ORIGIN_AIRPORT,
    CASE WHEN l_partkey % 50 = 0 THEN CAST(c_nationkey + 10000 AS VARCHAR)
         ELSE {_code('c_nationkey')} END AS DESTINATION_AIRPORT,
    CAST(((l_orderkey + l_linenumber) % 24) * 100 + l_partkey % 60 AS INTEGER) AS SCHEDULED_DEPARTURE,
    CASE WHEN is_cancelled AND l_partkey % 7 <> 0 THEN NULL ELSE {_hhmm(_ACT_DEP)} END AS DEPARTURE_TIME,
    CASE WHEN is_cancelled THEN NULL ELSE CAST({_DELAY} AS DOUBLE) END AS DEPARTURE_DELAY,
    CASE WHEN is_cancelled THEN NULL ELSE CAST({_TAXI_OUT} AS DOUBLE) END AS TAXI_OUT,
    CASE WHEN is_cancelled THEN NULL ELSE {_hhmm(_OFF)} END AS WHEELS_OFF,
    CAST({_SCHED} AS DOUBLE) AS SCHEDULED_TIME,
    CASE WHEN is_cancelled OR is_diverted THEN NULL ELSE CAST({_ELAPSED} AS DOUBLE) END AS ELAPSED_TIME,
    CASE WHEN is_cancelled OR is_diverted THEN NULL ELSE CAST({_AIR} AS DOUBLE) END AS AIR_TIME,
    CASE WHEN l_partkey % 89 = 0 THEN -l_extendedprice ELSE l_extendedprice END / 100 AS DISTANCE,
    CASE WHEN is_cancelled OR is_diverted THEN NULL ELSE {_hhmm(_ON)} END AS WHEELS_ON,
    CASE WHEN is_cancelled OR is_diverted THEN NULL ELSE CAST({_TAXI_IN} AS DOUBLE) END AS TAXI_IN,
    {_hhmm(f'{_DEP_MIN} + CAST({_SCHED} AS BIGINT)')} AS SCHEDULED_ARRIVAL,
    CASE WHEN is_cancelled OR is_diverted THEN NULL ELSE {_hhmm(_ARR)} END AS ARRIVAL_TIME,
    CASE WHEN is_cancelled OR is_diverted THEN NULL ELSE CAST({_ARR_DELAY} AS DOUBLE) END AS ARRIVAL_DELAY,
    CAST(is_diverted AS INTEGER) AS DIVERTED,
    CAST(is_cancelled AS INTEGER) AS CANCELLED,
    CASE WHEN is_cancelled THEN chr(CAST(l_orderkey % 4 + 65 AS INTEGER)) END AS CANCELLATION_REASON,
    CASE WHEN NOT (is_cancelled OR is_diverted) AND {_ARR_DELAY} >= 15
         THEN CAST((l_orderkey % 3) * 5 AS DOUBLE) END AS AIR_SYSTEM_DELAY,
    CASE WHEN NOT (is_cancelled OR is_diverted) AND {_ARR_DELAY} >= 15
         THEN CAST(0 AS DOUBLE) END AS SECURITY_DELAY,
    CASE WHEN NOT (is_cancelled OR is_diverted) AND {_ARR_DELAY} >= 15
         THEN CAST({_ARR_DELAY} - (l_orderkey % 3) * 5 - (l_partkey % 4) * 2 - (l_suppkey % 5) * 3 AS DOUBLE)
         END AS AIRLINE_DELAY,
    CASE WHEN NOT (is_cancelled OR is_diverted) AND {_ARR_DELAY} >= 15
         THEN CAST((l_suppkey % 5) * 3 AS DOUBLE) END AS LATE_AIRCRAFT_DELAY,
    CASE WHEN NOT (is_cancelled OR is_diverted) AND {_ARR_DELAY} >= 15
         THEN CAST((l_partkey % 4) * 2 AS DOUBLE) END AS WEATHER_DELAY
  FROM ({FLIGHTS_BASE}) b
"""

WEATHER = f"""
  SELECT station, CAST(m AS INTEGER) AS "month", CAST(week * 4 - residue AS INTEGER) AS "day", "hour",
    {", ".join(P.WEATHER_FIELDS)}
  FROM (SELECT {_code('user_id % 25')} AS station, user_id % 4 AS residue, CAST(hour(ts) AS INTEGER) AS "hour",
    round(avg(value) / 10 - 5, 6) AS temperature_c,
    round(coalesce(sum(value) FILTER (WHERE event_type = 'click') / 20.0, 0.0), 6) AS precipitation_mm,
    round(coalesce(sum(value) FILTER (WHERE event_type = 'purchase') / 25.0, 0.0), 6) AS rain_mm,
    round(coalesce(sum(value) FILTER (WHERE event_type = 'signup' AND value > 300) / 50, 0.0), 6) AS snowfall_cm,
    round(max(value) / 5, 6) AS wind_speed_kmh,
    round(CAST(min(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS DOUBLE) * 3.6, 6) AS wind_direction_deg,
    round(max(value) / 4, 6) AS wind_gusts_kmh,
    CAST(least(count(*) * 10, 100) AS DOUBLE) AS cloud_cover_pct,
    CAST(count(DISTINCT event_type) AS DOUBLE) AS weather_code,
    round(avg(CAST(json_extract_string(props, '$.k') AS INTEGER)), 6) AS relative_humidity_pct,
    round(avg(value) / 5 + 1000, 6) AS pressure_msl_hpa
  FROM events
  GROUP BY 1, 2, 3) observed, range(1, 13) months(m), range(1, 8) weeks(week)
"""

AIRPORTS = f"""
  SELECT {_code('n_nationkey')} AS IATA_CODE,
    CASE WHEN n_nationkey <> 23 THEN CAST(n_nationkey + 25 AS DOUBLE) END AS LATITUDE,
    CASE WHEN n_nationkey <> 23 THEN CAST(n_nationkey * -2 - 70 AS DOUBLE) END AS LONGITUDE,
    CASE WHEN n_nationkey <> 23 THEN
      ['America/New_York', 'America/Chicago', 'America/Denver',
       'America/Los_Angeles', 'Pacific/Honolulu'][n_regionkey % 5 + 1] END AS TZ
  FROM nation
"""

AIRLINES = "SELECT DISTINCT c_mktsegment AS IATA_CODE FROM customer"


def with_views(body: str, **views: str) -> str:
    """``WITH name AS (sql), ... body``."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}"


def label_sql(delay: str = "DEPARTURE_DELAY", cancelled: str = "CANCELLED") -> str:
    return (f"CASE WHEN {cancelled} = 1 THEN 'cancelled' WHEN {delay} IS NULL THEN NULL "
            f"WHEN {delay} <= {P.ON_TIME_MAX_DELAY} THEN 'on_time' "
            f"WHEN {delay} <= {P.MINOR_DELAY_MAX_DELAY} THEN 'minor_delay' "
            "ELSE 'major_delay' END")


def _eastern(ts: str, tz: str) -> str:
    # an ambiguous fall-back hour takes the earlier (daylight) offset;
    # DuckDB alone would take the later one
    instant = (f"least(timezone({tz}, {ts}), "
               f"timezone({tz}, {ts} - INTERVAL 1 HOUR) + INTERVAL 1 HOUR)")
    return (f"(CASE WHEN {tz} = '{P.EASTERN_TZ}' THEN {ts} "
            f"ELSE timezone('{P.EASTERN_TZ}', {instant}) END)")


_WX_FIELDS = ", ".join(P.WEATHER_FIELDS)
_O_FIELDS = ", ".join(f"wo.{c} AS {c}" for c in P.WEATHER_FIELDS)
_D_FIELDS = ", ".join(f"wd.{c} AS dest_{c}" for c in P.WEATHER_FIELDS)

# H1 matches month, day and hour
ENRICHED_BODY = f"""
  SELECT * EXCLUDE (o_ts, d_ts, otz, dtz, o_e, d_e) FROM (
    SELECT k.*, {_O_FIELDS}, {_D_FIELDS} FROM (
      SELECT z.*, {_eastern('o_ts', 'otz')} AS o_e, {_eastern('d_ts', 'dtz')} AS d_e FROM (
        SELECT f.*,
          CAST(SCHEDULED_DEPARTURE // 100 AS INTEGER) AS departure_hour,
          CAST(SCHEDULED_ARRIVAL // 100 AS INTEGER) AS scheduled_arrival_hour,
          coalesce(ao.TZ, '{P.EASTERN_TZ}') AS otz, coalesce(ad.TZ, '{P.EASTERN_TZ}') AS dtz,
          try(make_timestamp(f."YEAR", f."MONTH", f."DAY", SCHEDULED_DEPARTURE // 100, 0, 0)) AS o_ts,
          coalesce(
            try(make_timestamp(f."YEAR", f."MONTH",
                CAST(coalesce(f."DAY" + floor(((SCHEDULED_DEPARTURE // 100) * 60 + SCHEDULED_TIME) / 1440), f."DAY") AS BIGINT),
                SCHEDULED_ARRIVAL // 100, 0, 0)),
            try(make_timestamp(f."YEAR", f."MONTH", f."DAY", SCHEDULED_ARRIVAL // 100, 0, 0))) AS d_ts
        FROM flights f
        LEFT JOIN (SELECT IATA_CODE, max(TZ) AS TZ FROM airports
                   WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL GROUP BY 1) ao
          ON f.ORIGIN_AIRPORT = ao.IATA_CODE
        LEFT JOIN (SELECT IATA_CODE, max(TZ) AS TZ FROM airports
                   WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL GROUP BY 1) ad
          ON f.DESTINATION_AIRPORT = ad.IATA_CODE
      ) z
    ) k
    LEFT JOIN weather wo ON k.ORIGIN_AIRPORT = wo.station
         AND month(k.o_e) = wo."month" AND day(k.o_e) = wo."day" AND hour(k.o_e) = wo."hour"
    LEFT JOIN weather wd ON k.DESTINATION_AIRPORT = wd.station
         AND month(k.d_e) = wd."month" AND day(k.d_e) = wd."day" AND hour(k.d_e) = wd."hour"
  )
"""

BASE_VIEWS = {"flights": FLIGHTS, "weather": WEATHER, "airports": AIRPORTS}


def over_enriched(body: str, **extra: str) -> str:
    """SQL with ``flights``, ``weather``, ``airports`` and ``enriched`` as CTEs."""
    return with_views(body, **BASE_VIEWS, enriched=ENRICHED_BODY, **extra)


def over_flights(body: str, **extra: str) -> str:
    return with_views(body, flights=FLIGHTS, **extra)


def _is_digits(c: str) -> str:
    return f"regexp_matches({c}, '^[0-9]+$')"


CAPPED_PRESENT = [c for c in P.CAPPED_COLUMNS if c not in P.LEAKAGE_COLUMNS]
_LEAK = ", ".join(P.LEAKAGE_COLUMNS)

# H2: cleaning job on the enriched view.
STAGED_BODY = f"""
  SELECT * FROM (
    SELECT * EXCLUDE ({_LEAK}, DEPARTURE_DELAY, CANCELLED),
           {label_sql()} AS {P.TARGET}
    FROM enriched
    WHERE NOT coalesce({_is_digits('ORIGIN_AIRPORT')} OR {_is_digits('DESTINATION_AIRPORT')}, false)
  ) WHERE {P.TARGET} IS NOT NULL
"""
_BOUNDS = ", ".join(
    f"quantile_cont({c}, {P.CAP_LOWER_Q}) AS {c}__lo, quantile_cont({c}, {P.CAP_UPPER_Q}) AS {c}__hi"
    for c in CAPPED_PRESENT)
_CLIPPED = ", ".join(
    f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least(CAST({c} AS DOUBLE), {c}__hi), {c}__lo) END AS {c}"
    for c in CAPPED_PRESENT)
CAPPED_BODY = f"""
  SELECT s.* REPLACE ({_CLIPPED})
  FROM staged s, (SELECT {_BOUNDS} FROM staged) b
"""


def cleaned_views() -> dict:
    return {"staged": STAGED_BODY, "capped": CAPPED_BODY}


def cleaned_where(columns: list[str]) -> str:
    keep = [c for c in columns if c not in P.NULLABLE_AFTER_CLEANING]
    return " AND ".join(f"{c} IS NOT NULL" for c in keep)
