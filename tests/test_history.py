"""Gap-filled price history, hand-worked cases G1-G5, plus invariants on the sf0.001 archive."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faresight.operators import archive

SCHEMA = ("air_id string, route_key string, window_date date, seat_class string, airline string, "
          "agt_code string, fare_class string, fetched_date date, fare int, depart_date date")
W = dt.date(2024, 1, 10)


def _frame(spark, rows):
    d = dt.date.fromisoformat
    data = [(a, "A00_A03", W, "Y", al, "AGT0", "F", d(f), fare, d(dep)) for a, al, f, fare, dep in rows]
    return spark.createDataFrame(data, SCHEMA)


def _max(df):
    return df.groupBy(*archive.ROUTE_DAY).agg(F.max("fetched_date").alias("max_fetched"))


def _history(spark, rows, air_id="X"):
    out = archive.price_history(_frame(spark, rows), _max(_frame(spark, rows))).where(F.col("air_id") == air_id)
    return [(r.collected_date, r.collected_day, r.days_to_departure, r.price, r.is_available)
            for r in out.orderBy("collected_date").collect()]


def test_g1_gap_fill(spark):
    rows = [("X", "AL1", "2024-01-05", 100, "2024-01-10"), ("X", "AL1", "2024-01-07", 120, "2024-01-10"),
            ("Y", "AL1", "2024-01-08", 50, "2024-01-10")]  # Y only sets the route-day max to 01-08
    assert _history(spark, rows) == [("2024-01-05", "금", 5, 100, True), ("2024-01-06", "토", 4, None, False),
                                     ("2024-01-07", "일", 3, 120, True), ("2024-01-08", "월", 2, None, False)]


def test_g2_departure_clamp(spark):
    rows = [("X", "AL1", "2024-01-08", 90, "2024-01-10"), ("X", "AL1", "2024-01-10", 95, "2024-01-10"),
            ("Y", "AL1", "2024-01-12", 1, "2024-01-13")]  # route-day max 01-12
    assert _history(spark, rows) == [("2024-01-08", "월", 2, 90, True), ("2024-01-09", "화", 1, None, False)]


@pytest.mark.parametrize("fetched", ["2024-01-10", "2024-01-12"])
def test_g3_g4_empty_history_offer_listed(spark, fetched):
    rows = [("X", "AL1", fetched, 70, "2024-01-10")]
    assert _history(spark, rows) == []
    offers = archive.archive_offers(_frame(spark, rows), _max(_frame(spark, rows))).collect()
    assert [o.option_id for o in offers] == ["Y.AL1.AGT0.F"]
    doc = archive.price_history_doc(_frame(spark, rows), _max(_frame(spark, rows))).first()
    assert doc.prices["Y.AL1.AGT0.F"].price_history == []


def test_g5_null_airline_counts_in_route_max(spark):
    rows = [("X", "AL1", "2024-01-05", 100, "2024-01-10"),
            ("Z", None, "2024-01-07", 10, "2024-01-10")]  # null airline: no offer, but max -> 01-07
    offers = archive.archive_offers(_frame(spark, rows), _max(_frame(spark, rows))).collect()
    assert [(o.air_id, str(o.end_date)) for o in offers] == [("X", "2024-01-08")]
    assert len(_history(spark, rows)) == 3


def test_history_days_are_consecutive_and_available_match(tables, spark, duck):
    from faresight.plans import catalog
    from faresight.plans.oracle import ORACLE
    ph = archive.price_history(*catalog._archive_inputs(spark, "/root/testdata/sf0.001"))
    per = (ph.groupBy("air_id", "option_id")
           .agg(F.count("*").alias("n"), F.min("collected_date").alias("a"), F.max("collected_date").alias("b")))
    bad = per.where(F.datediff(F.to_date("b"), F.to_date("a")) + 1 != F.col("n")).count()
    assert bad == 0
    s = ph.agg(F.count("*").alias("rows"), F.sum(F.col("is_available").cast("int")).alias("avail"),
               F.sum("price").alias("price_sum")).first()
    want = duck.execute(f"SELECT count(*), count(*) FILTER (is_available), sum(price) FROM ({ORACLE['price_history']})").fetchall()[0]
    assert (s.rows, s.avail, s.price_sum) == want


def test_duplicate_fare_key_keeps_highest_fare(spark):
    """A duplicated fare key (outside the table's invariant) picks the highest fare instead of failing."""
    rows = [("X", "AL1", "2024-01-05", 100, "2024-01-07"), ("X", "AL1", "2024-01-05", 130, "2024-01-07"),
            ("X", "AL1", "2024-01-06", 90, "2024-01-07")]
    assert _history(spark, rows) == [("2024-01-05", "금", 2, 130, True), ("2024-01-06", "토", 1, 90, True)]
