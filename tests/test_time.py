"""Clock helpers: business-day windows, zone conversion across DST, run dates, weekdays (G8, G9)."""

import datetime as dt

from pyspark.sql import functions as F

from faresight.functions import time as T


def _one(spark, col, value, cast="timestamp_ntz"):
    df = spark.range(1).select(F.lit(value).cast(cast).alias("x"))
    return df.select(col.alias("y")).first()["y"]


def test_day_boundary_seoul(spark):  # G8
    assert _one(spark, T.local_date("x"), "2024-01-20 14:59:59") == dt.date(2024, 1, 20)
    assert _one(spark, T.local_date("x"), "2024-01-20 15:00:00") == dt.date(2024, 1, 21)


def test_dst_new_york(spark):  # G9
    ny = "America/New_York"
    assert _one(spark, T.local_time("x", ny), "2024-03-10 06:59:00") == dt.datetime(2024, 3, 10, 1, 59)
    assert _one(spark, T.local_time("x", ny), "2024-03-10 07:00:00") == dt.datetime(2024, 3, 10, 3, 0)
    assert _one(spark, T.local_time("x", ny), "2024-07-01 00:00:00") == dt.datetime(2024, 6, 30, 20, 0)


def test_zone_column(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "Asia/Tokyo"), ("2024-01-01 00:00:00", "Europe/Paris")],
                               "t string, z string")
    out = df.select(T.local_time(F.to_timestamp_ntz("t"), F.col("z")).alias("l")).collect()
    assert [r.l for r in out] == [dt.datetime(2024, 1, 1, 9, 0), dt.datetime(2024, 1, 1, 1, 0)]


def test_window_bounds():
    assert T.day_window_bounds("2024-01-28") == (dt.datetime(2024, 1, 27, 15), dt.datetime(2024, 1, 28, 15))
    assert T.day_window_bounds("2024-01-28", days=2)[1] == dt.datetime(2024, 1, 29, 15)


def test_in_day_window_half_open(spark):
    df = spark.createDataFrame([("2024-01-27 14:59:59",), ("2024-01-27 15:00:00",), ("2024-01-28 14:59:59",),
                                ("2024-01-28 15:00:00",), (None,)], "t string")
    out = df.select(T.in_day_window(F.to_timestamp_ntz("t"), "2024-01-28").alias("w")).collect()
    assert [r.w for r in out] == [False, True, True, False, None]


def test_run_date():
    assert T.run_date("2024-01-27T15:00:00Z") == dt.date(2024, 1, 29)
    assert T.run_date("2024-01-27T14:59:59+00:00") == dt.date(2024, 1, 28)
    assert T.run_date("2024-01-28T00:00:00+09:00") == dt.date(2024, 1, 29)


def test_business_date_column(spark):
    assert _one(spark, T.business_date("x"), "2024-01-27 15:00:00") == dt.date(2024, 1, 29)


def test_weekday_kr(spark):
    got = [_one(spark, T.weekday_kr("x"), f"2024-01-{d:02d}", "date") for d in range(8, 15)]
    assert got == ["월", "화", "수", "목", "금", "토", "일"]


def test_multi_day_window_matches_sql(spark, duck, tables):
    from faresight.operators import archive
    from faresight.plans.catalog import fixture_routes
    from faresight.plans.oracle import with_views
    fw = archive.flights_in_window(tables.flights, fixture_routes(spark, "/root/testdata/sf0.001"),
                                   day="2024-01-27", days=2)
    got = sorted((r.air_id, str(r.window_date)) for r in fw.select("air_id", "window_date").collect())
    want = duck.execute(with_views("""
        SELECT fi.air_id, CAST(CAST(timezone('Asia/Seoul', timezone('UTC', fi.depart_timestamp)) AS DATE) AS VARCHAR)
        FROM flight_info fi JOIN routes r USING (depart_airport, arrival_airport)
        WHERE fi.depart_timestamp >= TIMESTAMP '2024-01-26 15:00:00'
          AND fi.depart_timestamp < TIMESTAMP '2024-01-28 15:00:00'""")).fetchall()
    assert got == sorted(want)
    assert {d for _, d in got} == {"2024-01-27", "2024-01-28"}


def test_jdbc_reader_requires_complete_partitioning(spark):
    import pytest
    from faresight.sources.tables import read_jdbc
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:postgresql://unused/db", "fare_info", partition_column="batch_id")


def test_run_dates_of_text(spark):
    """Offsets as written, none as UTC, in any session zone; what is no instant is null."""
    from faresight.functions.time import business_date_of_text, instant_of_text
    cases = {"2024-01-27T00:00:00Z": ("2024-01-27 00:00:00", "2024-01-28"), "2024-01-27T00:00:00+09:00": ("2024-01-26 15:00:00", "2024-01-28"),
             "2024-01-26 23:59:59+0900": ("2024-01-26 14:59:59", "2024-01-27"), "2024-01-27": ("2024-01-27 00:00:00", "2024-01-28"),
             "2024-01-27T15:00": ("2024-01-27 15:00:00", "2024-01-29"), "2024-01-27-05:30": ("2024-01-27 05:30:00", "2024-01-28"),
             " 2024-11-03T05:30:00.5Z ": ("2024-11-03 05:30:00.500000", "2024-11-04"), "2024-11-03T06:30:00Z": ("2024-11-03 06:30:00", "2024-11-04"),
             "2024-03-10T07:30:00Z": ("2024-03-10 07:30:00", "2024-03-11"), "1969-12-31T23:59:59Z": ("1969-12-31 23:59:59", "1970-01-02")}
    bad = ["2024-02-30T00:00:00Z", "2024-01-27T24:00:00Z", "2024-1-5", "2024-01-27T10:00:00+19:00", "n/a", "", "now", "20240127", "2024-01-27T00:00:00 Europe/Paris"]
    df = spark.createDataFrame([(t,) for t in [*cases, *bad, None]], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", session)
            got = {r.t: (r.i and str(r.i), r.d and str(r.d)) for r in df.select("t", instant_of_text("t").alias("i"), business_date_of_text("t").alias("d")).collect()}
            assert got == {**cases, **{t: (None, None) for t in [*bad, None]}}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
