"""DuckDB twins of the feature, encoding and sampling queries."""

from __future__ import annotations

from pushback import profile as P

TWO_PI = "CAST(6.283185307179586 AS DOUBLE)"
DH = "(SCHEDULED_DEPARTURE // 100)"
AH = "(SCHEDULED_ARRIVAL // 100)"


def bank(h: str = DH) -> str:
    b, names = P.DEPARTURE_BANK_BOUNDS, P.DEPARTURE_BANK_LABELS
    whens = " ".join(f"WHEN {h} >= {lo} AND {h} < {hi} THEN '{n}'"
                     for lo, hi, n in zip(b[:-1], b[1:], names))
    return f"(CASE {whens} END)"


def bank_code(h: str = DH) -> str:
    b = P.DEPARTURE_BANK_BOUNDS
    whens = " ".join(f"WHEN {h} >= {lo} AND {h} < {hi} THEN {i}"
                     for i, (lo, hi) in enumerate(zip(b[:-1], b[1:])))
    return f"CAST(CASE {whens} END AS INTEGER)"


def holidays(src: str) -> str:
    """Observed federal holidays for the source's year range, by rule."""
    return f"""
      SELECT CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END AS h
      FROM (SELECT make_date(y, m, dd) AS d, y, m
            FROM (SELECT unnest(range(lo, hi + 1)) AS y
                  FROM (SELECT min("YEAR") AS lo, max("YEAR") AS hi FROM {src})) yrs,
                 (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) v(m, dd))
      WHERE NOT (m = 6 AND y < 2021)
      UNION ALL
      SELECT f + CAST((wd - isodow(f) + 7) % 7 + 7 * (n - 1) AS INTEGER)
      FROM (SELECT make_date(y, m, 1) AS f, y, m, wd, n
            FROM (SELECT unnest(range(lo, hi + 1)) AS y
                  FROM (SELECT min("YEAR") AS lo, max("YEAR") AS hi FROM {src})) yrs,
                 (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) v(m, wd, n))
      WHERE NOT (m = 1 AND y < 1986)
      UNION ALL
      SELECT l - CAST((isodow(l) - 1 + 7) % 7 AS INTEGER)
      FROM (SELECT last_day(make_date(y, 5, 1)) AS l
            FROM (SELECT unnest(range(lo, hi + 1)) AS y
                  FROM (SELECT min("YEAR") AS lo, max("YEAR") AS hi FROM {src})) yrs)"""


def temporal(src: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
    r = lambda e: f"(round({e}, 9) + CAST(0 AS DOUBLE))"
    peaks = ", ".join(f"CAST({DH} BETWEEN {lo} AND {hi} AS INTEGER) AS {n}"
                      for n, (lo, hi) in P.PEAK_BANKS.items())
    return f"""
      SELECT row_id, CAST(DAY_OF_WEEK IN (6, 7) AS INTEGER) AS is_weekend,
        CAST(coalesce(make_date("YEAR", "MONTH", "DAY") IN (SELECT h FROM ({holidays(src)})), false) AS INTEGER) AS is_holiday,
        {r(f"sin({DH} * {TWO_PI} / 24)")} AS scheduled_departure_hour_sin,
        {r(f"cos({DH} * {TWO_PI} / 24)")} AS scheduled_departure_hour_cos,
        {r(f"sin({AH} * {TWO_PI} / 24)")} AS scheduled_arrival_hour_sin,
        {r(f"cos({AH} * {TWO_PI} / 24)")} AS scheduled_arrival_hour_cos,
        {r(f'sin(("MONTH" - 1) * {TWO_PI} / 12)')} AS month_sin,
        {r(f'cos(("MONTH" - 1) * {TWO_PI} / 12)')} AS month_cos,
        {bank()} AS departure_hour_bucket, {bank_code()} AS departure_hour_bucket_code,
        {peaks}
      FROM {src}"""


def _flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS DOUBLE)"


def intensity(prefix: str = "") -> str:
    t = P.WEATHER_INTENSITY_THRESHOLDS
    p = prefix
    return (f"({_flag(f'{p}precipitation_mm >= {t['precipitation_mm']} OR {p}rain_mm >= {t['rain_mm']}')}"
            f" + {_flag(f'{p}snowfall_cm > {t['snowfall_cm']}')}"
            f" + {_flag(f'{p}wind_speed_kmh >= {t['wind_speed_kmh']} OR {p}wind_gusts_kmh >= {t['wind_gusts_kmh']}')}"
            f" + {_flag(f'{p}temperature_c <= {P.FREEZING_C}')})")


def congestion(src: str) -> str:
    r = lambda e: f"round({e}, 9)"
    o, d, w = "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DAY_OF_WEEK"
    return f"""
      SELECT row_id, ohc AS origin_hourly_departure_count, obc AS origin_departure_bank_count,
        {r(f"ocr")} AS origin_congestion_ratio, {r("obr")} AS origin_departure_bank_ratio,
        dhc AS destination_hourly_arrival_count, dbc AS destination_departure_bank_count,
        {r("dcr")} AS destination_congestion_ratio, {r("dbr")} AS destination_departure_bank_ratio,
        oi AS origin_weather_intensity, di AS destination_weather_intensity,
        {r("ocr * oi")} AS origin_congestion_weather_score,
        {r("dcr * di")} AS destination_congestion_weather_score,
        {r("(ocr + dcr) * (oi + di)")} AS route_congestion_weather_score,
        {r("obr * oi")} AS origin_departure_bank_weather_score,
        {r("dbr * di")} AS destination_departure_bank_weather_score
      FROM (
        SELECT *, ohc / avg(ohc) OVER (PARTITION BY {o}, {w}) AS ocr,
                  obc / avg(obc) OVER (PARTITION BY {o}, {w}) AS obr,
                  dhc / avg(dhc) OVER (PARTITION BY {d}, {w}) AS dcr,
                  dbc / avg(dbc) OVER (PARTITION BY {d}, {w}) AS dbr
        FROM (
          SELECT *, count(*) OVER (PARTITION BY {o}, {w}, dh) AS ohc,
                    count(*) OVER (PARTITION BY {o}, {w}, bk) AS obc,
                    count(*) OVER (PARTITION BY {d}, {w}, ah) AS dhc,
                    count(*) OVER (PARTITION BY {d}, {w}, bk) AS dbc,
                    {intensity('')} AS oi, {intensity(P.DEST_PREFIX)} AS di
          FROM (SELECT *, {DH} AS dh, {AH} AS ah, {bank()} AS bk FROM {src})))"""


def keys_expr() -> dict[str, str]:
    route = "(ORIGIN_AIRPORT || '_' || DESTINATION_AIRPORT)"
    bk = bank()
    dow = "CAST(DAY_OF_WEEK AS VARCHAR)"
    return {
        "AIRLINE": "AIRLINE", "ORIGIN_AIRPORT": "ORIGIN_AIRPORT",
        "DESTINATION_AIRPORT": "DESTINATION_AIRPORT", "ROUTE": route,
        "AIRLINE_DEPARTURE_BANK": f"(AIRLINE || '_' || {bk})",
        "ORIGIN_AIRPORT_DEPARTURE_BANK": f"(ORIGIN_AIRPORT || '_' || {bk})",
        "ORIGIN_AIRPORT_DAY_OF_WEEK": f"(ORIGIN_AIRPORT || '_' || {dow})",
        "AIRLINE_ROUTE": f"(AIRLINE || '_' || {route})",
        "ROUTE_DEPARTURE_BANK": f"({route} || '_' || {bk})",
        "ROUTE_DAY_OF_WEEK": f"({route} || '_' || {dow})",
    }


def interaction_keys(src: str) -> str:
    k = keys_expr()
    cols = ", ".join(f"{k[n]} AS {n}" for n in ["ROUTE"] + list(P.INTERACTION_HISTORICAL_KEYS))
    return f"SELECT row_id, {cols} FROM {src}"


def _ranked(src: str, part: str, salt: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY {part}
                   ORDER BY md5(concat_ws('|', row_id, '{P.RANDOM_STATE}', '{salt}')), row_id) AS __rk,
                 count(*) OVER (PARTITION BY {part}) AS __n FROM {src}"""


def stratified_sample(src: str, strata: str = '"MONTH"', frac: float = P.SAMPLE_FRACTION) -> str:
    return f"""SELECT * EXCLUDE (__rk, __n) FROM ({_ranked(src, strata, 'sample')})
               WHERE __rk <= round_even(__n * CAST({frac} AS DOUBLE), 0)"""


def split_flags(src: str, size: float = P.TEST_SIZE) -> str:
    return f"""SELECT * EXCLUDE (__rk, __n),
                 (__n > 1 AND __rk <= greatest(1, least(round_even(__n * CAST({size} AS DOUBLE), 0), __n - 1))) AS is_test
               FROM ({_ranked(src, P.TARGET, 'split')})"""


def folds(train: str) -> str:
    k = f"""(SELECT greatest(2, least(5, count(*) // greatest(count(DISTINCT {P.TARGET}), 2))) FROM {train})"""
    return f"""SELECT row_id, {P.TARGET}, CAST((__rk - 1) % {k} AS INTEGER) AS fold
               FROM ({_ranked(train, P.TARGET, 'fold')})"""


def frequency(split: str) -> str:
    parts = []
    for c in P.FREQUENCY_COLUMNS:
        parts.append(f"""LEFT JOIN (SELECT {c} AS k, count(*) / (SELECT count({c}) FROM {split} WHERE NOT is_test) AS f
                   FROM {split} WHERE NOT is_test AND {c} IS NOT NULL GROUP BY {c}) f_{c} ON s.{c} = f_{c}.k""")
    cols = ", ".join(
        f"round(CASE WHEN is_test THEN coalesce(f_{c}.f, 0.0) ELSE f_{c}.f END, 9) AS {c}_freq"
        for c in P.FREQUENCY_COLUMNS)
    return f"SELECT row_id, is_test, {cols} FROM {split} s " + " ".join(parts)


def smoothed_rates(split: str) -> str:
    keys = keys_expr()
    names = {**P.HISTORICAL_KEYS, **P.INTERACTION_HISTORICAL_KEYS}
    ind = {n: f"CAST({P.TARGET} IN ({', '.join(repr(c) for c in cls)}) AS DOUBLE)"
           for n, cls in P.HISTORICAL_RATES.items()}
    m = P.HISTORICAL_SMOOTHING
    prior = ", ".join(f"avg({e}) AS g_{n}" for n, e in ind.items())
    base = (f"SELECT *, {', '.join(f'{keys[k]} AS k_{k}' for k in names)}, "
            f"{', '.join(f'{e} AS y_{n}' for n, e in ind.items())} FROM {split}")
    joins, cols = [], []
    for k, prefix in names.items():
        sums = ", ".join(f"sum(y_{n}) AS s_{n}" for n in ind)
        joins.append(f"""LEFT JOIN (SELECT k_{k} AS kk, count(*) AS n, {sums} FROM b
                          WHERE NOT is_test AND k_{k} IS NOT NULL GROUP BY 1) j_{k} ON b.k_{k} = j_{k}.kk""")
        for n in ind:
            tr = f"(j_{k}.s_{n} - b.y_{n} + {m} * g.g_{n}) / (j_{k}.n - 1 + {m})"
            te = f"(j_{k}.s_{n} + {m} * g.g_{n}) / (j_{k}.n + {m})"
            cols.append(f"round(coalesce(CASE WHEN is_test THEN {te} ELSE {tr} END, g.g_{n}), 9) AS {prefix}_{n}")
    return f"""SELECT * FROM (WITH b AS ({base}), g AS (SELECT {prior} FROM b WHERE NOT is_test)
               SELECT b.row_id, b.is_test, {', '.join(cols)} FROM b CROSS JOIN g {' '.join(joins)})"""


DISCRETE = ["DAY_OF_WEEK", "is_weekend", "is_holiday", "departure_hour_bucket_code",
            "is_morning_peak_bank", "is_evening_peak_bank", "weather_code", "dest_weather_code",
            "DIVERTED"]


def mutual_information(feat: str) -> str:
    casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in DISCRETE)
    on = ", ".join(f'"{c}"' for c in DISCRETE)
    return f"""
      SELECT "column", round(sum(nxy / n * ln(nxy * n / (nx * ny))), 9) AS mutual_info FROM (
        SELECT *, sum(nxy) OVER (PARTITION BY "column") AS n,
                  sum(nxy) OVER (PARTITION BY "column", bin) AS nx,
                  sum(nxy) OVER (PARTITION BY "column", y) AS ny
        FROM (SELECT "column", value AS bin, y, count(*) AS nxy FROM (
                UNPIVOT (SELECT {P.TARGET} AS y, {casts} FROM {feat})
                ON {on} INTO NAME "column" VALUE value)
              WHERE value IS NOT NULL AND y IS NOT NULL GROUP BY ALL))
      GROUP BY "column\""""
