"""Archive job over stored tables: document every departed flight of a business day, then delete.

One Spark job covers all routes of the day (instead of a query per route): windowed flights ->
documents -> partitioned JSON under ``route_key=…/window_date=…``. The delete step uses the same
window, so nothing is removed that was not offered to the archive (the flights removed without a
document — no fare, or not on a listed route — are counted and reported).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faresight.constants import BUSINESS_ZONE
from faresight.functions.time import in_day_window
from faresight.operators import archive, merge
from faresight.sources import sinks


@dataclass
class ArchiveResult:
    archive_path: str
    flights_path: str
    archived: int
    removed: int
    removed_unarchived: int
    counts: dict[str, int] = field(default_factory=dict)


def build_documents(flights: DataFrame, airports: DataFrame, fares: DataFrame, layovers: DataFrame,
                    routes: DataFrame, day=None, days: int = 1, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Documents of the flights departing in the window (every departure day when ``day`` is None)."""
    fw = archive.flights_in_window(flights, routes, day, days, zone)
    return archive.archive_documents(fw, airports, fares, layovers, flights)


def run_archive(spark: SparkSession, flights: DataFrame, airports: DataFrame, fares: DataFrame,
                layovers: DataFrame, routes: DataFrame, day: str | dt.date, archive_path: str, flights_path: str,
                zone: str = BUSINESS_ZONE, step: Callable[[str], None] | None = None) -> ArchiveResult:
    """Write the day's documents, then the flight table without that day's departures to ``flights_path``.

    Run again after an interruption it writes the documents anew (their folders are replaced) and finishes the
    flight table where it was (:func:`faresight.sources.sinks.publish_snapshot`), with the same counts:
    documents, and flights scanned, removed, undecided (no departure) and kept, each counted in the plan that writes (again, should
    Spark not report what it counted there).
    """
    documents, scanned, kept = Observation("documents"), Observation("flights"), Observation("kept")
    hit = F.coalesce(in_day_window("depart_timestamp", day, zone), F.lit(False))

    def recount() -> dict[str, int]:
        return flights.agg(F.count(F.when(hit, 1)).alias("removed"), F.count(F.lit(1)).alias("scanned"), F.count(F.when(F.col("depart_timestamp").isNull(), 1)).alias("undecided"),
                           F.count(F.when(~hit, 1)).alias("kept")).first().asDict()

    docs = build_documents(flights, airports, fares, layovers, routes, day, 1, zone)
    sinks.write_archive(docs, archive_path, documents)
    left = merge.delete_departed(flights, day, zone, observation=scanned).observe(kept, F.count(F.lit(1)).alias("kept"))
    counts = {"documents": 0, "scanned": 0, "removed": 0, "undecided": 0, "kept": 0} | sinks.observed(documents, recount=lambda: {"documents": docs.count()}) \
        | sinks.publish_snapshot(left, flights_path, str(day), [scanned, kept], step, recount)
    return ArchiveResult(archive_path, flights_path, counts["documents"], counts["removed"], counts["removed"] - counts["documents"], counts)
