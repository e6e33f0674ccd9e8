"""Stream ingest: bounded micro-batches, replay-safe landing, restart adds nothing, rejects kept."""

import datetime
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from faresight.session import scratch_path, local_path
from faresight.streaming import ingest


def _write_json_files(tables, root, n_files):
    src = f"{root}/2024-01-28/international"
    tables.landing.repartition(n_files).write.json(src)
    return src


def test_json_batches_of_two_files_then_restart_adds_nothing(spark, tables):
    root = scratch_path(spark, "stream-test")
    src = _write_json_files(tables, root, 5)
    landing, ckpt = f"{root}/landing", f"{root}/ckpt"
    q = ingest.start_ingest(ingest.read_fare_stream(spark, src, max_files=2), landing, ckpt,
                            rejects_path=f"{root}/rejects", available_now=True)
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(sizes) == 3  # files per batch: 2, 2, 1
    landed = ingest.read_landing(spark, landing)
    assert landed.count() == tables.landing.count()
    one_day = landed.where(F.col("fetched_date") == F.lit("2024-01-28").cast("date"))
    assert "PartitionFilters: [isnotnull(fetched_date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == tables.landing.where(F.col("fetched_date") == F.lit("2024-01-28").cast("date")).count()
    assert landed.select("epoch_id").distinct().count() == 3
    cols = [c for c in tables.landing.columns]
    assert landed.select(*cols).exceptAll(tables.landing.select(*cols)).count() == 0

    q2 = ingest.start_ingest(ingest.read_fare_stream(spark, src, max_files=2), landing, ckpt,
                             rejects_path=f"{root}/rejects", available_now=True)
    q2.awaitTermination()
    assert ingest.read_landing(spark, landing).count() == tables.landing.count()


def test_malformed_lines_go_to_rejects(spark):
    root = scratch_path(spark, "stream-bad")
    src = local_path(f"{root}/src")
    os.makedirs(src, exist_ok=True)
    good = {"batch_id": 1, "air_id": "F1", "seat_class": "Y", "agt_code": "AGT0", "adult_fare": 10,
            "fetched_date": "2024-01-28", "fare_class": "F"}
    with open(f"{src}/part-0.json", "w") as f:
        f.write(json.dumps(good) + "\n{not json\n")
    q = ingest.start_ingest(ingest.read_fare_stream(spark, src), f"{root}/landing", f"{root}/ckpt",
                            rejects_path=f"{root}/rejects", available_now=True)
    q.awaitTermination()
    assert ingest.read_landing(spark, f"{root}/landing").count() == 1
    rejects = spark.read.parquet(f"{root}/rejects")
    assert [r._corrupt_record for r in rejects.collect()] == ["{not json"]


def test_parquet_source_from_test_table(spark):
    root = scratch_path(spark, "stream-pq")
    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    stream = ingest.read_fare_stream(spark, "/root/testdata/sf0.001", schema=schema, fmt="parquet",
                                     path_glob="events.parquet")
    cols = [f.name for f in schema.fields]
    landed = ingest.Landed()
    q = ingest.start_ingest(stream, f"{root}/landing", f"{root}/ckpt", f"{root}/rejects", columns=cols, available_now=True, landed=landed)
    q.awaitTermination()
    assert ingest.read_landing(spark, f"{root}/landing", schema=schema).count() == landed.rows == 1000


def test_replayed_epoch_overwrites_its_own_partition(spark, tables):
    root = scratch_path(spark, "stream-replay")
    write = ingest._landing_writer(f"{root}/landing", f"{root}/rejects", "2024-01-28", [c for c in tables.landing.columns])
    batch = tables.landing.limit(10).withColumn("source_file", F.lit("f")) \
        .withColumn("file_modification_time", F.current_timestamp())
    write(batch, 0)
    write(batch, 0)  # the same epoch again after a failure
    assert ingest.read_landing(spark, f"{root}/landing").count() == 10


def test_processing_time_trigger_stops_when_idle(spark, tables):
    root = scratch_path(spark, "stream-idle")
    src = _write_json_files(tables, root, 2)
    q = ingest.start_ingest(ingest.read_fare_stream(spark, src), f"{root}/landing", f"{root}/ckpt", f"{root}/rejects",
                            trigger="1 second")
    assert ingest.run_until_idle(q, idle_seconds=3, max_seconds=120) <= tables.landing.count()
    assert not q.isActive
    assert ingest.read_landing(spark, f"{root}/landing").count() == tables.landing.count()


def _json_file(folder, name, rows):
    os.makedirs(local_path(folder), exist_ok=True)
    with open(local_path(f"{folder}/{name}"), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def _record(batch_id, air_id, date, fare=10):
    return {"batch_id": batch_id, "air_id": air_id, "seat_class": "Y", "agt_code": "A", "adult_fare": fare, "fetched_date": date, "fare_class": "F"}


def test_two_run_dates_share_a_landing_table_with_merge_and_purge(spark):
    """Late rows of the first date come with the second run; static overwrite mode; every row is accounted for."""
    from faresight.plans import merge_job
    root = scratch_path(spark, "two-runs")
    t = merge_job.Tables(f"{root}/a", f"{root}/f", f"{root}/fares", f"{root}/landing", f"{root}/agg")
    spark.createDataFrame([("old", "Y", "A", 5, datetime.date(2024, 1, 1), "F")], "air_id string, seat_class string, agt_code string, adult_fare int, "
                          "fetched_date date, fare_class string").write.partitionBy("fetched_date").parquet(t.fares)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        _json_file(f"{root}/src/d1", "a.json", [_record(1, "x", "2024-01-28"), _record(2, "y", "2024-01-28"), _record(3, "null", None)])
        _json_file(f"{root}/src/d2", "a.json", [_record(4, "z", "2024-01-29"), _record(5, "late", "2024-01-28"), _record(6, "x", "2024-01-28", 11)])
        for run in ("d1", "d2"):
            ingest.start_ingest(ingest.read_fare_stream(spark, f"{root}/src/{run}"), t.landing, f"{root}/ckpt/{run}", f"{root}/rejects",
                                available_now=True).awaitTermination()
        assert sorted(r.batch_id for r in ingest.read_landing(spark, t.landing).collect()) == [1, 2, 3, 4, 5, 6]
        _, moved = merge_job.migrate(spark, t, "2024-01-28")
        assert moved == 5 and merge_job.purge(spark, t, "2024-01-28") == (t.landing, 4)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert sorted(r.batch_id for r in ingest.read_landing(spark, t.landing).collect()) == [3, 4]
    assert sorted((r.air_id, r.adult_fare) for r in spark.read.parquet(t.fares).collect()) \
        == [("late", 10), ("null", 10), ("old", 5), ("x", 11), ("y", 10), ("z", 10)]


def test_files_without_batch_ids_are_merged_before_the_purge(spark):
    from faresight.plans import merge_job
    root = scratch_path(spark, "no-batch")
    t = merge_job.Tables(f"{root}/a", f"{root}/f", f"{root}/fares", f"{root}/landing", f"{root}/agg")
    spark.createDataFrame([("old", "Y", "A", 5, datetime.date(2024, 1, 1), "F")], "air_id string, seat_class string, agt_code string, adult_fare int, "
                          "fetched_date date, fare_class string").write.partitionBy("fetched_date").parquet(t.fares)
    rows = [{k: v for k, v in _record(0, "x", "2024-01-28", fare).items() if k != "batch_id"} for fare in (30, 20)]
    for run, row in zip(("d1", "d2"), rows):
        _json_file(f"{root}/src/{run}", "a.json", [row])
        ingest.start_ingest(ingest.read_fare_stream(spark, f"{root}/src/{run}"), t.landing, f"{root}/ckpt/{run}", f"{root}/rejects",
                            available_now=True).awaitTermination()
    assert merge_job.migrate(spark, t, "2024-01-28")[1] == 1 and merge_job.purge(spark, t, "2024-01-28")[1] == 2
    assert sorted((r.air_id, r.adult_fare) for r in spark.read.parquet(t.fares).collect()) == [("old", 5), ("x", 20)]


def test_a_long_batch_is_not_idle():
    """The clock starts with the last batch that had input; a running batch reports nothing, another query's events don't count."""
    from types import SimpleNamespace
    now = [0.0]
    watch = ingest.IdleWatch("r", 10, lambda: now[0])

    def at(second, event, run="r", rows=None):
        now[0] = second
        event(SimpleNamespace(runId=run, progress=SimpleNamespace(runId=run, numInputRows=rows)))
        return watch.done.is_set()

    assert not at(5, watch.onQueryIdle)
    assert not at(100, watch.onQueryProgress, rows=7)      # a batch of 95 seconds
    assert not at(109, watch.onQueryIdle)
    assert not at(150, watch.onQueryIdle, run="other") and not at(150, watch.onQueryTerminated, run="other")
    assert not at(150, watch.onQueryProgress, rows=3) and watch.rows == 10
    assert at(160, watch.onQueryIdle)


def test_a_query_that_fails_says_so(spark, tables):
    root = scratch_path(spark, "stream-fails")
    src = _write_json_files(tables, root, 3)

    def fail(epoch):
        raise OSError("lost between write and commit")

    q = ingest.start_ingest(ingest.read_fare_stream(spark, src, max_files=1), f"{root}/landing", f"{root}/ckpt", f"{root}/rejects", trigger="1 second", after_write=fail)
    with pytest.raises(StreamingQueryException):
        ingest.run_until_idle(q, idle_seconds=30, max_seconds=60)
    before = ingest.read_landing(spark, f"{root}/landing").count()
    assert 0 < before < tables.landing.count()
    ingest.start_ingest(ingest.read_fare_stream(spark, src, max_files=1), f"{root}/landing", f"{root}/ckpt", f"{root}/rejects", available_now=True).awaitTermination()
    assert ingest.read_landing(spark, f"{root}/landing").count() == tables.landing.count()


def test_an_epoch_has_a_file_for_each_date(spark, tables):
    root = scratch_path(spark, "stream-files")
    tables.landing.where("day(fetched_date) IN (21, 22, 23)").repartition(8).write.json(f"{root}/src")
    ingest.start_ingest(ingest.read_fare_stream(spark, f"{root}/src"), f"{root}/landing", f"{root}/ckpt", f"{root}/rejects", available_now=True).awaitTermination()
    files = [r.f for r in ingest.read_landing(spark, f"{root}/landing").select(F.col("_metadata.file_path").alias("f")).distinct().collect()]
    dates = tables.landing.where("day(fetched_date) IN (21, 22, 23)").select("fetched_date").distinct().count()
    assert len(files) == dates > 1
