"""Daily aggregate-and-merge job over stored tables: aggregate -> retention -> migrate -> purge.

Tables are parquet folders; the fact tables are partitioned by ``fetched_date``. Upserts rewrite only
the partitions they touch (dynamic partition overwrite, staged first because a job cannot overwrite
the files it is reading). A change set is computed once: it is staged, and its dates and row count are read
from there. The landing table is the one that :mod:`faresight.streaming.ingest` writes, which may go on landing
epochs while this job runs: migration records the epochs that it read, and the purge removes exactly those.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.constants import AGG_COLUMNS, AGG_KEY, FARE_COLUMNS, FARE_KEY, RETENTION_DAYS
from faresight.operators import aggregate, merge
from faresight.session import scratch_path
from faresight.sources import removal
from faresight.sources.sinks import overwrite_partitions, partition_values
from faresight.streaming.ingest import read_landing

PART = "fetched_date"


@dataclass
class Tables:
    """Folders of the stored tables (``agg`` may not exist yet on the first run)."""
    airports: str
    flights: str
    fares: str
    landing: str
    agg: str


@dataclass
class MergeResult:
    tables: Tables
    counts: dict = field(default_factory=dict)


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _upsert_in_place(spark: SparkSession, current: DataFrame | None, changes: DataFrame, key: list[str],
                     path: str) -> tuple[list, int]:
    """Rewrite the partitions of ``path`` that ``changes`` touches; returns their values and the changed rows.

    The distinct dates of the staged change set reach the driver: one value per day, bounded by the calendar.
    """
    staged = scratch_path(spark, "changes")
    changes.write.parquet(staged)
    changes = spark.read.schema(changes.schema).parquet(staged)
    touched = {r[0]: r[1] for r in changes.groupBy(PART).agg(F.count(F.lit(1))).collect()}
    if not touched:
        return [], 0
    if current is None:
        overwrite_partitions(changes, path, PART)
    else:
        staging = scratch_path(spark, "staging")
        merge.upsert_partitions(current, changes, key, PART, list(touched)).write.parquet(staging)
        overwrite_partitions(spark.read.schema(current.schema).parquet(staging), path, PART)
    return list(touched), sum(touched.values())


def aggregate_and_upsert(spark: SparkSession, t: Tables, day, agg_exists: bool = True, landing: DataFrame | None = None) -> tuple[list, int]:
    """Aggregate landing rows of ``day`` and upsert them into the aggregate table: dates, and rows upserted."""
    landing = landing if landing is not None else read_landing(spark, t.landing)
    flights, airports = _read(spark, t.flights), _read(spark, t.airports)
    fresh = aggregate.fare_daily_agg(landing, flights, airports, day).select(*AGG_COLUMNS)
    current = _read(spark, t.agg).select(*AGG_COLUMNS) if agg_exists else None
    return _upsert_in_place(spark, current, fresh, list(AGG_KEY), t.agg)


def retention(spark: SparkSession, t: Tables, day) -> tuple[str, int]:
    """Remove the aggregate rows fetched on or before ``day - 2``; returns (folder, removed rows).

    The delete predicate is on the partition column, so whole files go (rows with a null date
    live in the default partition and stay, as SQL keeps rows whose predicate is null). What goes is recorded
    first: a run that was interrupted is finished, and counted, by the next one.
    """
    cutoff = dt.date.fromisoformat(str(day)) - dt.timedelta(days=RETENTION_DAYS)
    name = f"retention-{day}"
    removed = removal.finish(spark, t.agg, name)
    old = [v for v in partition_values(spark, t.agg, PART) if v is not None and v <= cutoff]
    if old:
        agg = _read(spark, t.agg)
        removal.confirm(spark, t.agg, name, removal.prepare(agg.where(agg[PART].isin(old)), t.agg, name))
        removed += removal.finish(spark, t.agg, name)
    return t.agg, removed


def migrate(spark: SparkSession, t: Tables, day, landing: DataFrame | None = None) -> tuple[list, int]:
    """Move ``day``'s landing rows, and others in its batch-id range, into the fare table (latest wins): dates, and rows upserted.

    The landing files are listed once, when ``landing`` is defined: those are read, and those of ``day`` are
    recorded for :func:`purge`. The record counts from when the fare table has the rows.
    """
    landing = landing if landing is not None else read_landing(spark, t.landing)
    pending = removal.prepare(landing.where(F.col(PART) == F.lit(day).cast("date")), t.landing, f"purge-{day}")
    row = merge.batch_bounds(landing, day).first()
    changes = merge.fare_latest(merge.landing_range(landing, day, row["min_batch_id"], row["max_batch_id"]))
    current = _read(spark, t.fares).select(*FARE_COLUMNS)
    moved = _upsert_in_place(spark, current, changes, list(FARE_KEY), t.fares)
    removal.confirm(spark, t.landing, f"purge-{day}", pending)
    return moved


def purge(spark: SparkSession, t: Tables, day) -> tuple[str, int]:
    """Remove the landed epochs of ``day`` that :func:`migrate` has read; returns (folder, removed rows).

    An epoch that landed since then stays for the next migration of the day. Without a migration nothing goes.
    """
    return t.landing, removal.finish(spark, t.landing, f"purge-{day}")


def run_daily_merge(spark: SparkSession, t: Tables, day: str | dt.date, agg_exists: bool = True) -> MergeResult:
    """The daily job in the order of the original pipeline: aggregate + upsert, retention, migration,
    landing purge, all on the landing files that are there when it starts. Returns the new table folders and row counts."""
    counts: dict = {}
    landing = read_landing(spark, t.landing)
    counts["agg_dates"], counts["agg_upserted"] = aggregate_and_upsert(spark, t, day, agg_exists, landing)
    agg_path, counts["agg_removed"] = retention(spark, t, day)
    counts["fare_dates"], counts["fare_upserted"] = migrate(spark, t, day, landing)
    landing_path, counts["landing_removed"] = purge(spark, t, day)
    return MergeResult(Tables(t.airports, t.flights, t.fares, landing_path, agg_path), counts)
