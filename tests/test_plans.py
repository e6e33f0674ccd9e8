"""End-to-end jobs on copies of the stored sf0.001 tables."""

from pyspark.sql import functions as F

from faresight.operators import aggregate
from faresight.plans import archive_job, merge_job
from faresight.plans.catalog import fixture_routes
from faresight.session import scratch_path

D = "2024-01-28"
BASE = "/root/testdata/sf0.001"


def _copy_tables(spark, tables):
    root = scratch_path(spark, "job-tables")
    t = merge_job.Tables(f"{root}/airports", f"{root}/flights", f"{root}/fares", f"{root}/landing",
                         f"{root}/agg")
    tables.airports.write.parquet(t.airports)
    tables.flights.write.parquet(t.flights)
    tables.fares.write.partitionBy("fetched_date").parquet(t.fares)
    tables.landing.write.partitionBy("fetched_date").parquet(t.landing)
    aggregate.fare_daily_agg(tables.fares, tables.flights, tables.airports) \
        .write.partitionBy("fetched_date").parquet(t.agg)
    return t


def test_daily_merge_job(spark, tables, oracle_count):
    t = _copy_tables(spark, tables)
    res = merge_job.run_daily_merge(spark, t, D)
    assert res.counts["agg_dates"]
    assert spark.read.parquet(res.tables.agg).count() == oracle_count("agg_retention")
    assert spark.read.parquet(t.fares).count() == oracle_count("fare_migrate")
    assert spark.read.parquet(res.tables.landing).count() == oracle_count("landing_purge")
    assert res.counts["landing_removed"] == tables.landing.count() - oracle_count("landing_purge")
    assert res.counts["agg_upserted"] == oracle_count("fare_daily_agg") and res.counts["fare_upserted"] > 0
    fares = spark.read.parquet(t.fares).dropna()
    assert fares.groupBy("air_id", "seat_class", "agt_code", "fetched_date", "fare_class").count() \
        .where("count > 1").count() == 0


def test_archive_job(spark, tables, oracle_count):
    routes = fixture_routes(spark, BASE)
    out = scratch_path(spark, "archive-job")
    res = archive_job.run_archive(spark, tables.flights, tables.airports, tables.fares, tables.layovers,
                                  routes, D, out, scratch_path(spark, "flights-next"))
    assert spark.read.parquet(res.flights_path).count() == oracle_count("expired_delete")
    assert res.removed == tables.flights.count() - oracle_count("expired_delete")
    docs = spark.read.json(out)
    assert docs.count() == res.archived
    assert docs.select("window_date").distinct().count() == 1
    # a removed flight without a document had no fare, or was on no listed route
    with_fare = tables.flights.join(tables.fares.select("air_id").distinct(), "air_id", "left_semi") \
        .join(routes, ["depart_airport", "arrival_airport"], "left_semi")
    assert res.removed - res.removed_unarchived == res.archived < res.removed
    assert res.archived == with_fare.where(F.col("depart_timestamp").between("2024-01-27 15:00:00",
                                                                               "2024-01-28 14:59:59")).count()
    # documents that another run left in the folder don't count as this one's
    again = archive_job.run_archive(spark, tables.flights.where("air_id = 'none'"), tables.airports, tables.fares, tables.layovers,
                                    routes, D, out, scratch_path(spark, "flights-next"))
    assert (again.archived, again.removed) == (0, 0)


def test_first_run_creates_aggregate_table(spark, tables, oracle_count):
    t = _copy_tables(spark, tables)
    fresh_path = scratch_path(spark, "agg-new")
    t0 = merge_job.Tables(t.airports, t.flights, t.fares, t.landing, fresh_path)
    dates, upserted = merge_job.aggregate_and_upsert(spark, t0, D, agg_exists=False)
    assert [str(d) for d in dates] == [D] and upserted == oracle_count("fare_daily_agg")
    assert spark.read.parquet(fresh_path).count() == upserted


def test_rerun_of_migration_changes_nothing(spark, tables):
    t = _copy_tables(spark, tables)
    merge_job.migrate(spark, t, D)
    first = spark.read.parquet(t.fares).select("air_id", "seat_class", "agt_code", "fetched_date",
                                                 "fare_class", "adult_fare").collect()
    merge_job.migrate(spark, t, D)
    second = spark.read.parquet(t.fares).select("air_id", "seat_class", "agt_code", "fetched_date",
                                                  "fare_class", "adult_fare").collect()
    # but for rows with a null key part, which conflict with nothing
    whole = [sorted((tuple(r) for r in rows if None not in tuple(r)[:5]), key=repr) for rows in (first, second)]
    assert whole[0] == whole[1]


def test_rows_without_a_date_are_migrated(spark, tables):
    """The job does what its operator does: a landing row with a null date in the id range moves."""
    from faresight.operators import merge
    t = _copy_tables(spark, tables)
    want = merge.migrate_day(tables.fares, tables.landing, D)
    merge_job.migrate(spark, t, D)
    got = spark.read.parquet(t.fares).select(*want.columns)
    assert got.where("fetched_date IS NULL").count() == want.where("fetched_date IS NULL").count() > 0
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_plans_start_no_job_and_shuffle_no_bucketed_fares(spark, tables):
    """Building an archive query runs nothing; shuffle partitions unlike the bucket count add no exchange of the fares."""
    from faresight.operators import archive
    sc, parts = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    routes = fixture_routes(spark, BASE)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        sc.setJobGroup("build-only", "no job may start")
        fw = archive.flights_in_window(tables.flights, routes)
        ex = archive.expired_fares(fw, tables.airports, tables.fares)
        history = archive.price_history(ex, archive.frame_max(fw, tables.airports, tables.fares))
        plan = history._jdf.queryExecution().toString()
        assert len(sc.statusTracker().getJobIdsForGroup("build-only")) == 0
        assert "REPARTITION_BY_COL" not in plan and "map_from_entries" not in plan and "map_contains_key" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_route_day_maximum_and_file_ranks_are_broadcast(spark, tables):
    """Fares are not dealt by route-day, nor landed rows by file: a few keys would hold them all."""
    from faresight.operators import archive, merge
    from faresight.streaming.ingest import read_landing
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fw = archive.flights_in_window(tables.flights, fixture_routes(spark, BASE))
        ex, frames = archive.expired_fares(fw, tables.airports, tables.fares), archive.frame_max(fw, tables.airports, tables.fares)
        for rows in (archive.price_history(ex, frames), archive.archive_offers(ex, frames)):
            assert rows._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(route_key") == 1   # the maximum's own
        path = scratch_path(spark, "landed-plan")
        tables.landing.write.partitionBy("fetched_date").parquet(path)
        plan = merge.fare_latest(read_landing(spark, path))._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
