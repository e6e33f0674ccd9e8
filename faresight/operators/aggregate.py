"""Daily fare aggregate: mean, exact median and count per route, local departure day, cabin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.functions.keys import airline_or_placeholder, route_key
from faresight.functions.time import local_time


def fare_daily_agg(landing: DataFrame, flights: DataFrame, airports: DataFrame, day=None) -> DataFrame:
    """Aggregate landing fares of ``day`` (every day if ``None``) per
    (route_key, departure-local year/month/day, is_layover, airline, seat_class, fare_class, fetched_date).

    Plan: the date filter reaches the landing scan (partition pruning when partitioned by fetched_date);
    fares join flights on ``air_id`` (co-partitioned when both are bucketed by air_id, else a shuffle
    join where AQE splits skewed ids); the flight-side group attributes are computed per flight before
    the join; the airport dimension is small, so the planner broadcasts it; the arrival airport is an
    existence check (semi join). ``median`` is Spark's exact percentile, whose partial aggregate keeps a
    value->count map per group, so a hot group is combined map-side and never materialised as a row list.
    """
    fa = landing.select("air_id", "seat_class", "fare_class", "adult_fare", "fetched_date")
    if day is not None:
        fa = fa.where(F.col("fetched_date") == F.lit(day).cast("date"))
    dims = airports.select("airport_code", "time_zone")
    dep = dims.select(F.col("airport_code").alias("depart_airport"), F.col("time_zone").alias("dep_zone"))
    arr = dims.select(F.col("airport_code").alias("arrival_airport"))
    # Group attributes of a flight are computed once per flight (zone conversion included), on the
    # flight side of the join, not once per fare row.
    fl = (flights.select("air_id", "is_layover", "airline", "depart_airport", "arrival_airport",
                         "depart_timestamp")
          .join(dep, "depart_airport")
          .join(arr, "arrival_airport", "left_semi"))
    local_dep = local_time("depart_timestamp", F.col("dep_zone"))
    per_flight = fl.select(
        "air_id",
        route_key().alias("route_key"),
        F.year(local_dep).alias("depart_year"),
        F.month(local_dep).alias("depart_month"),
        F.dayofmonth(local_dep).alias("depart_day"),
        "is_layover",
        airline_or_placeholder().alias("airline"))
    keyed = fa.join(per_flight, "air_id")
    return (keyed.groupBy("route_key", "depart_year", "depart_month", "depart_day", "is_layover", "airline",
                          "seat_class", "fare_class", "fetched_date")
            .agg(F.avg("adult_fare").alias("mean_price"),
                 F.median("adult_fare").cast("double").alias("median_price"),
                 F.count(F.lit(1)).alias("ticket_count")))
