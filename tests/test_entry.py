import duckdb
import pytest

import __spark_entry__ as E
from pushback.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "not_on_time_share" in df.columns


def test_every_query_has_a_callable():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", ["enriched_flights", "clean_flights", "validation_report",
                                  "smoothed_rates", "model_selection", "worst_slices"])
def test_query_matches_sql_twin_small(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    got = sorted(tuple(_n(v) for v in (r[c] for c in sorted(df.columns))) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(_n(r[i]) for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def _n(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{round(v, 6) + 0.0:.6f}"
    return str(v)
