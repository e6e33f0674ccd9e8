"""Recorded removals: the folders that a delete takes away, and their rows, are written down before anything goes.

A table that a stream writes to goes on growing while a job works on it. A removal therefore names what
the job has read, not what a predicate finds later: the folder of each landed epoch, or each file where the
table has no such folders. What comes after the record stays. A record is open from the time that its job's
work is done until all it names is gone, so a removal that was interrupted is finished by running it again, and
reports the same number of rows. Records lie under ``_removals`` in the table's folder, which readers pass over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.sources.files import Store

RECORDS = "_removals"


def units(rows: DataFrame) -> DataFrame:
    """path, n: what to remove, to remove the files that ``rows`` are read from. ``rows`` must be a scan with filters on partitions at most."""
    path = F.col("_metadata.file_path")
    epoch = F.regexp_extract(path, "^(.*/epoch_id=[^/]*)/[^/]*$", 1)
    return rows.select(F.when(epoch != "", epoch).otherwise(path).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def prepare(rows: DataFrame, table: str, name: str) -> str:
    """Write down what removing ``rows`` from ``table`` means. The record does nothing before :func:`confirm`."""
    pending = f"{table}/{RECORDS}/pending/{name}-{uuid.uuid4().hex[:12]}"
    units(rows).write.parquet(pending)
    return pending


def confirm(spark: SparkSession, table: str, name: str, pending: str) -> None:
    """The work that had to come before the removal is done."""
    Store(spark, table).move(pending, f"{table}/{RECORDS}/{name}/{pending.rsplit('/', 1)[-1]}")


def finish(spark: SparkSession, table: str, name: str) -> int:
    """Remove all that open records of ``name`` list; returns the rows it held, 0 if nothing is open.

    Interrupted and run again it removes the rest and returns the same. The list is read in pieces, a folder or
    file each; removing one is a call to the file system.
    """
    store, place = Store(spark, table), f"{table}/{RECORDS}/{name}"
    records = [f"{place}/{r}" for r in store.names(place)]
    if not records:
        return 0
    recorded = spark.read.schema("path string, n bigint").parquet(*records).groupBy("path").agg(F.max("n").alias("n"))
    removed, folders = 0, set()
    for row in recorded.toLocalIterator():
        store.delete(row["path"], is_uri=True)
        removed += row["n"]
        folders.add(row["path"].rsplit("/", 1)[0])
    for folder in sorted(folders, key=len, reverse=True):
        while "=" in folder.rsplit("/", 1)[-1]:           # partition folders that are empty now
            store.drop_if_empty(folder, is_uri=True)
            folder = folder.rsplit("/", 1)[0]
    for record in records:
        store.delete(record)
    return removed
