"""DuckDB twins of the exploration queries."""

from __future__ import annotations

from pushback import profile as P


def r9(e: str) -> str:
    return f"round({e}, 9)"


def class_distribution(src: str) -> str:
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(P.CLASS_ORDER))
    return f"""SELECT {P.TARGET} AS label, CAST(CASE {P.TARGET} {order} END AS INTEGER) AS class_order,
                 count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
               FROM {src} GROUP BY 1"""


def histogram(src: str, col: str, bins: int, trim: tuple | None) -> str:
    filt = f"{col} IS NOT NULL"
    if trim:
        filt += (f" AND {col} >= (SELECT quantile_cont({col}, {trim[0]}) FROM {src})"
                 f" AND {col} <= (SELECT quantile_cont({col}, {trim[1]}) FROM {src})")
    return f"""
      SELECT CAST(b AS INTEGER) AS bin, count(*) AS n, {r9('any_value(lo) + (b - 1) * any_value(w)')} AS bin_start,
             {r9('any_value(lo) + b * any_value(w)')} AS bin_end
      FROM (SELECT least(floor((v - lo) / w), {bins - 1}) + 1 AS b, lo, w
            FROM (SELECT CAST({col} AS DOUBLE) AS v FROM {src} WHERE {filt}) d,
                 (SELECT min(CAST({col} AS DOUBLE)) AS lo,
                         CASE WHEN max({col}) > min({col})
                              THEN (max(CAST({col} AS DOUBLE)) - min(CAST({col} AS DOUBLE))) / {bins}
                              ELSE 1.0 END AS w
                  FROM {src} WHERE {filt}) m)
      GROUP BY b"""


def box_stats(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(f"""
          SELECT s.{P.TARGET}, '{c}' AS "column", {r9('q1')} AS q1, {r9('med')} AS median, {r9('q3')} AS q3, n,
                 {r9(f"min(x.v) FILTER (WHERE x.v >= q1 - 1.5 * (q3 - q1) AND x.v <= q3 + 1.5 * (q3 - q1))")} AS whisker_low,
                 {r9(f"max(x.v) FILTER (WHERE x.v >= q1 - 1.5 * (q3 - q1) AND x.v <= q3 + 1.5 * (q3 - q1))")} AS whisker_high,
                 count(*) FILTER (WHERE NOT (x.v >= q1 - 1.5 * (q3 - q1) AND x.v <= q3 + 1.5 * (q3 - q1))) AS n_outliers
          FROM (SELECT {P.TARGET}, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS med,
                       quantile_cont({v}, 0.75) AS q3, count({v}) AS n
                FROM {src} WHERE {c} IS NOT NULL GROUP BY 1) s
          JOIN (SELECT {P.TARGET}, {v} AS v FROM {src} WHERE {c} IS NOT NULL) x
            ON s.{P.TARGET} IS NOT DISTINCT FROM x.{P.TARGET}
          GROUP BY s.{P.TARGET}, q1, med, q3, n""")
    return "\nUNION ALL\n".join(parts)


def crosstab(src: str, col: str, top: int) -> str:
    parts = []
    for c in P.CLASS_ORDER:
        parts.append(f"""SELECT CAST(t.{col} AS VARCHAR) AS segment, '{c}' AS {P.TARGET},
            {r9(f"count(*) FILTER (WHERE s.{P.TARGET} = '{c}') / count(*)")} AS proportion
          FROM {src} s JOIN (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY 1
                             ORDER BY count(*) DESC, 1 LIMIT {top}) t USING ({col})
          GROUP BY t.{col}""")
    return "\nUNION ALL\n".join(parts)


def correlation(src: str, cols: list[str]) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            e = r9(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))")
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {e} AS corr FROM {src}")
            if a != b:
                parts.append(f"SELECT '{b}' AS column_a, '{a}' AS column_b, {e} AS corr FROM {src}")
    return "\nUNION ALL\n".join(parts)


def profile(src: str, cols: list[str]) -> str:
    dtype = ("CASE typeof({c}) WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' "
             "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END")
    num = ("CASE WHEN typeof({c}) IN ('INTEGER', 'BIGINT', 'DOUBLE') "
           "THEN TRY_CAST({c} AS DOUBLE) END")
    shown = "CASE WHEN typeof({c}) = 'DOUBLE' THEN printf('%.6f', {c}) ELSE CAST({c} AS VARCHAR) END"
    parts = []
    for c in cols:
        parts.append(f"""
          SELECT '{c}' AS column_name, (SELECT {dtype.format(c=f'"{c}"')} FROM {src} LIMIT 1) AS dtype,
                 count("{c}") AS non_null,
                 round((count(*) - count("{c}")) * 100.0 / count(*), 2) AS null_pct,
                 count(DISTINCT CAST("{c}" AS VARCHAR)) AS "distinct",
                 (SELECT array_to_string(list(shown ORDER BY num NULLS LAST, raw)[1:3], ', ') FROM (
                    SELECT DISTINCT CAST("{c}" AS VARCHAR) AS raw,
                           {num.format(c=f'"{c}"')} AS num, {shown.format(c=f'"{c}"')} AS shown
                    FROM {src} WHERE "{c}" IS NOT NULL)) AS samples
          FROM {src}""")
    return "\nUNION ALL\n".join(parts)
