"""Property tests: upserts against a sequential SQL model; exact results for a hot group."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faresight.operators import merge

KEY = ["k1", "k2"]
SCHEMA = "k1 string, k2 int, v int"

keys = st.tuples(st.sampled_from(["a", "b", None]), st.integers(min_value=0, max_value=3))
rows = st.lists(st.tuples(keys, st.integers(min_value=0, max_value=9)), max_size=12)
landing_rows = st.lists(st.tuples(keys, st.integers(min_value=1, max_value=5),
                                  st.integers(min_value=0, max_value=9)), max_size=12)


def _model(current, landing):
    """Current rows, then landing rows applied in batch order (ties: larger value last), last wins.
    A key with a null part never matches anything (SQL ``=``), so such rows are always appended."""
    table = {}
    extra = []
    for (k, v) in current:
        if None in k:
            extra.append((k, v))
        else:
            table[k] = v
    latest = {}
    for (k, b, v) in landing:
        if None in k:
            extra.append((k, v))  # conflicts with nothing, not even an identical row
        elif k not in latest or (b, v) > latest[k][0]:
            latest[k] = ((b, v), v)
    for k, (_, v) in latest.items():
        table[k] = v
    return sorted([(k, v) for k, v in table.items()] + extra, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(current=rows, landing=landing_rows)
def test_upsert_matches_sequential_model(spark, current, landing):
    # the current table is key-unique (its primary key), as the fare table is
    seen, cur = set(), []
    for k, v in current:
        if None in k or k not in seen:
            cur.append((k, v))
            seen.add(k)
    cdf = spark.createDataFrame([(k[0], k[1], v) for k, v in cur], SCHEMA)
    ldf = spark.createDataFrame([(k[0], k[1], b, v) for k, b, v in landing], "k1 string, k2 int, b int, v int")
    changes = merge.latest_per_key(ldf, KEY, ["b", "v"]).select(*KEY, "v")
    got = sorted((((r.k1, r.k2), r.v) for r in merge.upsert(cdf, changes, KEY).collect()), key=repr)
    assert got == _model(cur, landing)


def test_latest_per_key_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("a", 1, 1, 5), ("a", 1, 2, 3), ("a", 1, 2, 4)], "k1 string, k2 int, b int, v int")
    assert [r.v for r in merge.latest_per_key(df, KEY, ["b", "v"]).collect()] == [4]


def test_retention_boundary(spark):
    d = dt.date(2024, 1, 28)
    df = spark.createDataFrame([(d - dt.timedelta(days=i),) for i in range(4)] + [(None,)], "fetched_date date")
    kept = sorted((r.fetched_date for r in merge.retain_recent(df, d).collect()), key=repr)
    assert kept == sorted([d, d - dt.timedelta(days=1), None], key=repr)  # D-2 and older removed


def test_hot_group_exact_results(spark):
    """One key holds a third of the rows (spread over every input partition): exact median, mean,
    count and latest-wins are unaffected by the partial (map-side) aggregation."""
    import statistics

    from faresight.operators import aggregate
    n = 30000
    hot = spark.range(0, n, numPartitions=8).select(
        F.lit("HOT").alias("air_id"), (F.col("id") % 997).cast("int").alias("adult_fare"),
        F.col("id").alias("batch_id"))
    cold = spark.range(0, 2 * n, numPartitions=8).select(
        F.concat(F.lit("C"), (F.col("id") % 500).cast("string")).alias("air_id"),
        (F.col("id") % 13).cast("int").alias("adult_fare"), (F.col("id") + n).alias("batch_id"))
    landing = hot.unionByName(cold).select(
        "batch_id", "air_id", F.lit("Y").alias("seat_class"), F.lit("AGT0").alias("agt_code"), "adult_fare",
        F.lit(dt.date(2024, 1, 28)).alias("fetched_date"), F.lit("F").alias("fare_class"))
    ids = [r.air_id for r in landing.select("air_id").distinct().collect()]
    flights = spark.createDataFrame(
        [(a, False, "A00", "A03", "AL1", dt.datetime(2024, 1, 30, 1), dt.datetime(2024, 1, 30, 3), 60)
         for a in ids],
        "air_id string, is_layover boolean, depart_airport string, arrival_airport string, airline string, "
        "depart_timestamp timestamp_ntz, arrival_timestamp timestamp_ntz, journey_time int")
    airports = spark.createDataFrame([("A00", "n0", "c0", "Asia/Seoul"), ("A03", "n3", "c3", "Asia/Tokyo")],
                                     "airport_code string, name string, country string, time_zone string")
    # every flight shares one group key here, so the aggregate has a single group of 3n rows
    r = aggregate.fare_daily_agg(landing, flights, airports, "2024-01-28").collect()
    fares = [i % 997 for i in range(n)] + [i % 13 for i in range(2 * n)]
    assert len(r) == 1 and r[0].ticket_count == 3 * n
    assert r[0].median_price == float(statistics.median(fares))
    assert abs(r[0].mean_price - sum(fares) / len(fares)) < 1e-9
    latest = {x.air_id: x.adult_fare for x in merge.fare_latest(landing).collect()}
    assert latest["HOT"] == (n - 1) % 997
    assert len(latest) == 501
