"""Every registered query against its DuckDB oracle on sf0.001 (rows, columns, values)."""

import datetime as dt
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from faresight.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(want_cols, want)


def test_entry_smoke(spark, oracle_count):
    df = E.entry(spark)
    assert df.count() == oracle_count("fare_daily_agg")
    assert df.columns == ["route_key", "depart_year", "depart_month", "depart_day", "is_layover", "airline",
                          "seat_class", "fare_class", "fetched_date", "mean_price", "median_price",
                          "ticket_count"]
