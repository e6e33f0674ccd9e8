"""Recorded removals: exactly what was read goes, an interrupted removal is finished, counts stay the same."""

import pytest
from pyspark.sql import functions as F

from faresight.plans import merge_job
from faresight.session import scratch_path
from faresight.sources import removal
from faresight.sources.files import Store
from faresight.streaming import ingest

D = "2024-01-28"


def _landed(spark, root, run, epoch, rows):
    df = spark.createDataFrame(rows, "batch_id long, air_id string, seat_class string, agt_code string, adult_fare int, fare_class string, day string")
    (df.select("*", F.col("day").cast("date").alias("fetched_date"), F.lit(run).alias("run"), F.lit(epoch).cast("long").alias("epoch_id"),
               F.lit(None).cast("timestamp").alias("file_modification_time"), F.lit("f").alias("source_file"), F.lit(0).cast("long").alias("position")).drop("day")
     .write.mode("append").partitionBy("fetched_date", "run", "epoch_id").parquet(f"{root}/landing"))


def _row(n, day=D):
    return n, f"F{n}", "Y", "A", 10 * n, "F", day


def _tables(spark, name):
    root = scratch_path(spark, name)
    t = merge_job.Tables(f"{root}/a", f"{root}/f", f"{root}/fares", f"{root}/landing", f"{root}/agg")
    _landed(spark, root, "a b:c", 0, [_row(1), _row(2), _row(3, "2024-01-29")])
    _landed(spark, root, "a b:c", 1, [_row(4)])
    spark.range(0).selectExpr("'x' air_id", "'Y' seat_class", "'A' agt_code", "1 adult_fare", "'F' fare_class", "date'2024-01-01' fetched_date") \
        .union(spark.sql("SELECT 'x', 'Y', 'A', 1, 'F', date'2024-01-01'")).write.partitionBy("fetched_date").parquet(t.fares)
    return root, t


def _left(spark, t):
    return sorted(r.batch_id for r in ingest.read_landing(spark, t.landing).collect())


def test_epochs_that_land_later_stay(spark):
    root, t = _tables(spark, "later")
    landing = ingest.read_landing(spark, t.landing)
    _landed(spark, root, "a b:c", 2, [_row(5)])
    assert merge_job.migrate(spark, t, D, landing)[1] == 4   # batch 3 of the next day is in the range of ids
    _landed(spark, root, "other", 0, [_row(6)])
    assert merge_job.purge(spark, t, D) == (t.landing, 3) and _left(spark, t) == [3, 5, 6]
    assert merge_job.migrate(spark, t, D)[1] == 2 and merge_job.purge(spark, t, D)[1] == 2 and _left(spark, t) == [3]


def test_nothing_goes_before_the_migration_is_done(spark, monkeypatch):
    root, t = _tables(spark, "before")
    assert merge_job.purge(spark, t, D)[1] == 0
    monkeypatch.setattr(merge_job, "_upsert_in_place", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge_job.migrate(spark, t, D)
    assert merge_job.purge(spark, t, D)[1] == 0 and _left(spark, t) == [1, 2, 3, 4]


def test_an_interrupted_removal_is_finished_and_counts_the_same(spark, monkeypatch):
    root, t = _tables(spark, "cut")
    merge_job.migrate(spark, t, D)
    merge_job.migrate(spark, t, D)            # a second record of the same epochs counts them once
    delete, calls = Store.delete, []

    def failing(self, path, is_uri=False):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        delete(self, path, is_uri)

    monkeypatch.setattr(Store, "delete", failing)
    with pytest.raises(OSError):
        merge_job.purge(spark, t, D)
    assert len(_left(spark, t)) in (2, 3)
    assert merge_job.purge(spark, t, D)[1] == 3 and _left(spark, t) == [3]
    assert merge_job.purge(spark, t, D)[1] == 0


def test_files_of_a_table_without_epochs(spark):
    path = scratch_path(spark, "flat")
    table = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    table.write.partitionBy("p").parquet(path)
    read = spark.read.parquet(path)
    pending = removal.prepare(read.where("p = 1"), path, "x")
    table.write.mode("append").partitionBy("p").parquet(path)
    removal.confirm(spark, path, "x", pending)
    assert removal.finish(spark, path, "x") == 5
    assert spark.read.parquet(path).where("p = 1").count() == 5 and spark.read.parquet(path).count() == 15
    pending = removal.prepare(spark.read.parquet(path), path, "x")
    removal.confirm(spark, path, "x", pending)
    assert removal.finish(spark, path, "x") == 15 and Store(spark, path).names(path) == ["_SUCCESS", "_removals"]


def test_files_are_written_whole(spark):
    path = scratch_path(spark, "files")
    store = Store(spark, path)
    store.write_text(f"{path}/a/b", "é")
    store.write_text(f"{path}/a/b", "ü")
    assert store.read_text(f"{path}/a/b") == "ü" and list(store.files(path)) == ["a/b"] and store.exists(f"{path}/a/b")
    store.delete(f"{path}/a/none")
    assert store.names(f"{path}/none") == []
