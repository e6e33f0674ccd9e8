"""Directed routes of the archive job: departures x selected arrivals, both directions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BROADCAST_ROWS = 50_000                       # routes, two short codes each: a few MB at most


def bounded(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table``, to be broadcast where it has at most ``rows`` rows; a longer one is left to the planner. Reads one row more than that at most."""
    return table.hint("broadcast") if table.limit(rows + 1).count() <= rows else table


def routes(region_airports: DataFrame, departures: Sequence[str], arrivals: Sequence[str] = (),
           arrival_regions: Sequence[str] = ()) -> DataFrame:
    """``(depart_airport, arrival_airport)`` pairs, forward and reverse, without duplicates.

    Arrivals are the airports named in ``arrivals``, in the region map or not, and every airport of
    ``arrival_regions``. Departures are a parameter list, attached to each arrival row by exploding
    literal arrays (no join): the result has ``2 * len(departures)`` rows per arrival, bounded by the
    configuration, not by the data. That bound is checked here, so that selecting flights by route is a look-up
    in the stage that scans them: ``distinct`` hides the size from the planner, which would shuffle all flights by route.
    """
    regional = region_airports.where(F.col("region").isin(list(arrival_regions))).select(F.col("iata").alias("arrival"))
    named = region_airports.sparkSession.createDataFrame([(a,) for a in arrivals], "arrival string")
    departure = F.explode(F.array(*[F.lit(d) for d in departures])).alias("departure")
    pairs = regional.unionByName(named).distinct().select("arrival", departure)
    both = F.array(F.struct(F.col("departure").alias("depart_airport"), F.col("arrival").alias("arrival_airport")),
                   F.struct(F.col("arrival").alias("depart_airport"), F.col("departure").alias("arrival_airport")))
    return bounded(pairs.select(F.inline(both)).distinct())
