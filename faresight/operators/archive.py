"""Archive of departed flights: route-day frames, flights, offers, gap-filled daily price history, legs.

One lazy plan covers every route and any number of local departure days (the window of a flight is the
business-zone day of its departure), instead of one query per route and day.

Scale notes:
- fares join the routed flights on ``air_id``; everything after that groups by ``air_id`` or a key that
  starts with it, so no later step re-shuffles fare rows by route.
- the route-day maximum of ``fetched_date`` (the only cross-flight value) is a partial aggregate: a busy
  route is combined map-side, and the result (routes x days rows) is broadcast to join back, so that offers stay
  where their flight is. Other small sides are left to the planner, which broadcasts by measured bytes.
- daily rows are generated *after* grouping to offers. An observed day lasts until the next one of its offer
  (or the end of the history): it is the available day with its price, the days after it are the gap. So
  the work is linear in the daily rows, each carries only keys, and no second shuffle joins prices to days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresight.constants import BUSINESS_ZONE, OFFER_KEY
from faresight.functions.keys import bool_text, option_id, route_key
from faresight.functions.time import (in_day_window, iso_date_text, local_date, local_time, ts_text,
                                      weekday_kr)

ROUTE_DAY = ["route_key", "window_date"]


def flights_in_window(flights: DataFrame, routes: DataFrame, day=None, days: int = 1,
                      zone: str = BUSINESS_ZONE) -> DataFrame:
    """Flights on the listed routes, with ``route_key`` and ``window_date`` (local departure day).

    With ``day`` only departures in ``[day 00:00, day + days 00:00)`` local time are kept; the bounds
    are literals, so the range is pushed to the scan. Without ``day`` every departure day is covered.
    """
    fl = flights
    if day is not None:
        fl = fl.where(in_day_window("depart_timestamp", day, zone, days))
    # A semi join: a route listed twice selects its flights once, and routes without flights add nothing.
    return (fl.join(routes.select("depart_airport", "arrival_airport"), ["depart_airport", "arrival_airport"], "left_semi")
            .withColumn("route_key", route_key())
            .withColumn("window_date", local_date("depart_timestamp", zone)))


def _airport_dims(airports: DataFrame):
    dims = airports.select("airport_code", "name", "country", "time_zone")
    dep = dims.select(*[F.col(c).alias(f"_dep_{c}") for c in dims.columns])
    arr = dims.select(*[F.col(c).alias(f"_arr_{c}") for c in dims.columns])
    return dep, arr


def expired_fares(flights_w: DataFrame, airports: DataFrame, fares: DataFrame) -> DataFrame:
    """Route-day frame rows: windowed flights x departure airport x arrival airport x fares.

    Column names follow the archive's naming (``airport_code(dep)``, ``fare``, ``depart_time(dep)`` …);
    ``depart_airport`` / ``arrival_airport`` are airport *names* here, the codes are in
    ``airport_code(dep)`` / ``airport_code(arr)``. ``depart_date`` is the departure-local day.
    """
    dep, arr = _airport_dims(airports)
    fw = (flights_w.join(dep, F.col("depart_airport") == F.col("_dep_airport_code"))
          .join(arr, F.col("arrival_airport") == F.col("_arr_airport_code")))
    dz, az = F.col("_dep_time_zone"), F.col("_arr_time_zone")
    # Flight-level columns (zone conversions included) are computed once per flight, before the
    # fare join multiplies the rows.
    per_flight = fw.select(
        "air_id", "is_layover", "route_key", "window_date",
        F.col("_dep_airport_code").alias("airport_code(dep)"),
        F.col("_dep_name").alias("depart_airport"),
        F.col("_dep_country").alias("depart_country"),
        F.col("_arr_airport_code").alias("airport_code(arr)"),
        F.col("_arr_name").alias("arrival_airport"),
        F.col("_arr_country").alias("arrival_country"),
        "airline",
        F.col("depart_timestamp").alias("depart_time(utc)"),
        F.col("arrival_timestamp").alias("arrival_time(utc)"),
        local_time("depart_timestamp", dz).alias("depart_time(dep)"),
        local_time("arrival_timestamp", dz).alias("arrival_time(dep)"),
        local_time("depart_timestamp", az).alias("depart_time(arr)"),
        local_time("arrival_timestamp", az).alias("arrival_time(arr)"),
        "journey_time")
    per_flight = per_flight.withColumn("depart_date", F.to_date(F.col("`depart_time(dep)`")))
    fa = fares.select("air_id", "seat_class", "agt_code", F.col("adult_fare").alias("fare"), "fare_class",
                      "fetched_date")
    return per_flight.join(fa, "air_id")


def archived_flights(flights_w: DataFrame, fares: DataFrame) -> DataFrame:
    """Windowed flights that have at least one fare (the flights a route-day document lists)."""
    return flights_w.join(fares.select("air_id"), "air_id", "left_semi")


def archive_flights(flights_w: DataFrame, airports: DataFrame, fares: DataFrame) -> DataFrame:
    """One row per archived flight with the document's flight fields.

    Flight attributes depend only on ``air_id``, so the rows come straight from the flight table
    (semi-joined to fares) instead of picking a representative among fare rows.
    """
    dep, arr = _airport_dims(airports)
    fl = (archived_flights(flights_w, fares)
          .join(dep.select("_dep_airport_code", "_dep_time_zone"),
                F.col("depart_airport") == F.col("_dep_airport_code"))
          .join(arr.select("_arr_airport_code", "_arr_time_zone"),
                F.col("arrival_airport") == F.col("_arr_airport_code")))
    return fl.select(
        "air_id", "route_key", "window_date",
        ts_text("depart_timestamp").alias("depart_time(utc)"),
        ts_text(local_time("depart_timestamp", F.col("_dep_time_zone"))).alias("depart_time(dep)"),
        ts_text("arrival_timestamp").alias("arrival_time(utc)"),
        ts_text(local_time("arrival_timestamp", F.col("_arr_time_zone"))).alias("arrival_time(arr)"),
        F.col("_dep_airport_code").alias("depart_airport"),
        F.col("_arr_airport_code").alias("arrival_airport"),
        bool_text("is_layover").alias("is_layover"),
        "journey_time")


def frame_max(flights_w: DataFrame, airports: DataFrame, fares: DataFrame) -> DataFrame:
    """Route-day maximum of ``fetched_date`` without the wide fare join.

    Fares are reduced to one ``max(fetched_date)`` per flight (two columns read, partial aggregation
    on the map side), joined to the windowed flights (with the same airport joins as the frame rows)
    and maximised per route-day; rows with a null airline count.
    """
    dep, arr = _airport_dims(airports)
    fl = (flights_w.join(dep.select("_dep_airport_code"), F.col("depart_airport") == F.col("_dep_airport_code"))
          .join(arr.select("_arr_airport_code"), F.col("arrival_airport") == F.col("_arr_airport_code"))
          .select("air_id", *ROUTE_DAY))
    last = fares.groupBy("air_id").agg(F.max("fetched_date").alias("_last"))
    return fl.join(last, "air_id").groupBy(*ROUTE_DAY).agg(F.max("_last").alias("max_fetched"))


def _complete(keys=OFFER_KEY) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


OFFER = ["air_id", *ROUTE_DAY, *OFFER_KEY]


def _observed_days(expired: DataFrame, frames: DataFrame) -> DataFrame:
    """One row per offer and observed day: fare, ``_next`` (the offer's next observed day), the offer's
    ``first_date``, ``dep_date`` and ``end_date = least(dep_date, route-day max + 1)``.

    The fare key makes a day unique already; should a duplicate appear, the highest fare is taken. Null
    days of an offer are kept (they make the offer exist) but are before any other. Everything
    runs on one partitioning: the keys all begin with the flight.
    """
    per_day = expired.groupBy(*OFFER, "fetched_date").agg(F.max("fare").alias("fare"), F.min("depart_date").alias("depart_date"))
    offer = Window.partitionBy(*OFFER)
    per_day = per_day.withColumns({"_next": F.lead("fetched_date").over(offer.orderBy("fetched_date")),
                                   "first_date": F.min("fetched_date").over(offer), "dep_date": F.min("depart_date").over(offer)})
    return per_day.join(F.broadcast(frames), ROUTE_DAY).withColumn("end_date", F.least(F.col("dep_date"), F.date_add(F.col("max_fetched"), 1))) \
                  .withColumn("option_id", option_id(*OFFER_KEY)).drop("max_fetched", "depart_date")


def _days() -> Column:
    """The days that an observed day stands for: from itself to the day before the next one or the history's end.

    ``sequence`` alone would count downward for a reversed range, hence the guard.
    """
    last = F.date_sub(F.least(F.col("_next"), F.col("end_date")), 1)
    return F.when(F.col("fetched_date") <= last, F.sequence(F.col("fetched_date"), last))


def archive_offers(expired: DataFrame, frames: DataFrame) -> DataFrame:
    """One row per offer (flight x seat class x airline x agency x fare class), rows with a null part
    dropped. Columns: option_id, the four parts, ``first_date`` (first collection), ``dep_date``
    (departure-local day), ``end_date = least(dep_date, route-day max + 1)`` (exclusive end of the
    history). ``frames`` is :func:`frame_max`.
    """
    offers = expired.where(_complete()).groupBy(*OFFER).agg(F.min("fetched_date").alias("first_date"), F.min("depart_date").alias("dep_date"))
    return (offers.join(F.broadcast(frames), ROUTE_DAY)
            .withColumn("end_date", F.least(F.col("dep_date"), F.date_add(F.col("max_fetched"), 1)))
            .withColumn("option_id", option_id(*OFFER_KEY)).drop("max_fetched"))


def _day_fields(d: Column, observed: Column, fare: Column, dep: Column) -> list[Column]:
    seen = d == observed
    return [iso_date_text(d).alias("collected_date"), weekday_kr(d).alias("collected_day"), F.datediff(dep, d).alias("days_to_departure"),
            F.when(seen, fare).cast("int").alias("price"), seen.alias("is_available")]


def price_history(expired: DataFrame, frames: DataFrame) -> DataFrame:
    """Flat gap-filled history: one row per offer and day. Offers with a null part are left out."""
    days = _observed_days(expired.where(_complete()), frames)
    return (days.select("air_id", *ROUTE_DAY, "option_id", "dep_date", "fetched_date", "fare", F.explode(_days()).alias("_day"))
            .select("air_id", *ROUTE_DAY, "option_id", *_day_fields(F.col("_day"), F.col("fetched_date"), F.col("fare"), F.col("dep_date"))))


_HISTORY = "array<struct<collected_date:string,collected_day:string,days_to_departure:int,price:int,is_available:boolean>>"


def _offer_entries(expired: DataFrame, frames: DataFrame) -> DataFrame:
    """One row per offer: its flight, and ``entry`` (key, {metadata, price_history}); null for offers with a null part."""
    days = _observed_days(expired, frames)
    part = F.transform(_days(), lambda d: F.struct(*_day_fields(d, F.col("fetched_date"), F.col("fare"), F.col("dep_date"))))
    parts = F.array_sort(F.collect_list(F.when(_complete(), F.struct(F.col("fetched_date"), F.coalesce(part, F.array().cast(_HISTORY)).alias("part")))))
    offers = days.groupBy(*OFFER, "option_id").agg(F.flatten(F.transform(parts, lambda x: x["part"])).alias("price_history"))
    metadata = F.struct("seat_class", "airline", F.col("agt_code").alias("agency"), "fare_class").alias("metadata")
    return offers.withColumn("entry", F.when(_complete(), F.struct(F.col("option_id").alias("key"), F.struct(metadata, "price_history").alias("value"))))


def _prices() -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list("entry"))).alias("prices")


def price_history_doc(expired: DataFrame, frames: DataFrame) -> DataFrame:
    """Per flight with a complete offer: ``prices`` map option_id -> {metadata, price_history},
    options in key order. Flight-level grouping reuses the offers' ``air_id`` partitioning."""
    return _offer_entries(expired.where(_complete()), frames).groupBy("air_id", *ROUTE_DAY).agg(_prices())


def layover_segments(layovers: DataFrame, archived: DataFrame, flights: DataFrame,
                     airports: DataFrame, ordered: bool = False) -> DataFrame:
    """Legs of the archived layover flights with each leg's own flight data and local times.

    ``archived`` carries ``air_id`` and ``is_layover``; a null flag does not select a flight.
    ``ordered=True`` sorts the rows by (air_id, layover_order) — a range-partitioned global sort, only
    worth it for a row listing; nested leg lists are ordered by :func:`layover_doc` without it.
    """
    sel = archived.where(F.col("is_layover")).select("air_id")
    legs = layovers.join(sel, "air_id", "left_semi")
    seg = flights.select(F.col("air_id").alias("segment_id"), F.col("airline").alias("segment_airline"),
                         F.col("depart_airport").alias("segment_depart"),
                         F.col("arrival_airport").alias("segment_arrival"),
                         F.col("depart_timestamp").alias("segment_depart_time_utc"),
                         F.col("arrival_timestamp").alias("segment_arrival_time_utc"),
                         F.col("journey_time").alias("segment_duration"))
    dep, arr = _airport_dims(airports)
    j = (legs.join(seg, "segment_id")
         .join(dep.select("_dep_airport_code", "_dep_time_zone"),
               F.col("segment_depart") == F.col("_dep_airport_code"))
         .join(arr.select("_arr_airport_code", "_arr_time_zone"),
               F.col("segment_arrival") == F.col("_arr_airport_code")))
    dz, az = F.col("_dep_time_zone"), F.col("_arr_time_zone")
    out = j.select(
        "air_id", "segment_id", "layover_order", "connect_time", "segment_airline", "segment_depart",
        "segment_arrival", "segment_depart_time_utc", "segment_arrival_time_utc",
        local_time("segment_depart_time_utc", dz).alias("segment_depart_time_in_dep"),
        local_time("segment_arrival_time_utc", dz).alias("segment_arrival_time_in_dep"),
        local_time("segment_depart_time_utc", az).alias("segment_depart_time_in_arr"),
        local_time("segment_arrival_time_utc", az).alias("segment_arrival_time_in_arr"),
        "segment_duration")
    return out.orderBy("air_id", "layover_order") if ordered else out


def layover_doc(segments: DataFrame) -> DataFrame:
    """Per layover flight: ``legs`` = ordered list of leg records (by ``layover_order``)."""
    leg = F.struct(F.col("segment_id"), F.col("layover_order").alias("segment_order"), "connect_time",
                   F.col("segment_airline").alias("airline"), F.col("segment_depart").alias("from"),
                   F.col("segment_arrival").alias("to"),
                   ts_text("segment_depart_time_utc").alias("depart_time_utc"),
                   ts_text("segment_arrival_time_utc").alias("arrival_time_utc"),
                   F.col("segment_duration").alias("duration"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("layover_order").alias("o"), leg.alias("leg"))))
    return segments.groupBy("air_id").agg(F.transform(ordered, lambda x: x["leg"]).alias("legs"))


def archive_documents(flights_w: DataFrame, airports: DataFrame, fares: DataFrame, layovers: DataFrame,
                      flights: DataFrame) -> DataFrame:
    """One document row per archived flight: ``flight`` fields, ``prices`` (``{}`` when the flight has
    no complete offer) and ``layover_info`` (ordered legs; null for direct flights).

    Fares are shuffled once by flight at most; offers and flights group on that partitioning, and no history is shuffled
    before the documents are written. The flight fields come from the flight table, the legs of the windowed layover flights are left-joined.
    """
    frames = frame_max(flights_w, airports, fares)
    prices = _offer_entries(expired_fares(flights_w, airports, fares), frames).groupBy("air_id", *ROUTE_DAY).agg(_prices())
    # The legs come from where their segments lie; merged with the flights they are grouped where the documents lie, and not the documents moved.
    segments = layover_segments(layovers, flights_w, flights, airports)
    legs = layover_doc(segments.join(flights_w.where(F.col("is_layover")).select("air_id").distinct().hint("merge"), "air_id"))
    fields = archive_flights(flights_w, airports, fares)
    flight = F.struct(*[c for c in fields.columns if c not in ("air_id", *ROUTE_DAY)]).alias("flight")
    # The join's only key is the flight, by which both sides lie already; were the route-day a key too, Spark would deal out all the
    # histories again. So the route-day is compared in a form that the planner takes for no key.
    own = F.col("f.air_id") == F.col("p.air_id")
    for c in ROUTE_DAY:
        own = own & F.coalesce(F.col(f"f.{c}") == F.col(f"p.{c}"), F.lit(False))
    told = fields.select("air_id", *ROUTE_DAY, flight).alias("f").join(prices.alias("p"), own).select(*[f"f.{c}" for c in ("air_id", *ROUTE_DAY, "flight")], "p.prices")
    return (told.join(legs, "air_id", "left")
            .select("air_id", *ROUTE_DAY, "flight", "prices", F.col("legs").alias("layover_info")))
