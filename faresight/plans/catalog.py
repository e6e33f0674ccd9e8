"""Registered queries: each callable takes (spark, base_dir) and returns a DataFrame.

Every query reads the whole test tables of ``base_dir`` (through the derived fare views) so its work grows
with them; computed columns are aliased (and doubles rounded to 4 places) to line up with
:mod:`faresight.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faresight.constants import AGG_COLUMNS, FARE_COLUMNS
from faresight.functions.time import business_date as business_date_col
from faresight.functions.time import business_date_of_text
from faresight.operators import aggregate, archive, merge
from faresight.operators.routes import routes as build_routes
from faresight.session import scratch_path
from faresight.sources import fixtures, region_map
from faresight.sources.tables import read_table

D = fixtures.RUN_DATE


def _round_agg(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if c in ("mean_price", "median_price") else F.col(c)
                       for c in AGG_COLUMNS])


_REGION_MAPS: dict[tuple[str, str], str] = {}


def region_map_path(spark: SparkSession, base: str, airports: DataFrame | None = None) -> str:
    """Region-map document of the test tables' airports, written once per application and base folder
    (it plays the part of the job's configuration file)."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _REGION_MAPS:
        airports = airports if airports is not None else fixtures.airport_info(spark, base)
        path = scratch_path(spark, "region-map")
        region_map.write_region_map(airports, path)
        _REGION_MAPS[key] = path
    return _REGION_MAPS[key]


_ROUTES: dict[tuple[str, str], DataFrame] = {}


def fixture_routes(spark: SparkSession, base: str, airports: DataFrame | None = None) -> DataFrame:
    """Routes of the test tables, read through the region-map document (S2); one lazy definition per
    application and folder."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _ROUTES:
        _ROUTES[key] = _build_routes(spark, base, airports)
    return _ROUTES[key]


def _build_routes(spark: SparkSession, base: str, airports: DataFrame | None) -> DataFrame:
    path = region_map_path(spark, base, airports)
    return build_routes(region_map.read_region_map(spark, path), fixtures.FIXTURE_DEPARTURES,
                        arrivals=fixtures.FIXTURE_ARRIVALS)


def _expired(spark: SparkSession, base: str):
    t = fixtures.load(spark, base)
    fw = archive.flights_in_window(t.flights, fixture_routes(spark, base, t.airports))
    return t, fw, archive.expired_fares(fw, t.airports, t.fares)


def _archive_inputs(spark: SparkSession, base: str):
    """Frame rows and the route-day maximum."""
    t, fw, ex = _expired(spark, base)
    return ex, archive.frame_max(fw, t.airports, t.fares)


# --- daily aggregate and merge -------------------------------------------------------------------

def q_fare_daily_agg(spark, base):
    t = fixtures.load(spark, base)
    return _round_agg(aggregate.fare_daily_agg(t.landing, t.flights, t.airports, D))


def q_fare_daily_agg_all(spark, base):
    t = fixtures.load(spark, base)
    return _round_agg(aggregate.fare_daily_agg(t.landing, t.flights, t.airports, None))


def _agg_upserted(spark, base):
    t = fixtures.load(spark, base)
    current = aggregate.fare_daily_agg(t.fares, t.flights, t.airports, None)
    fresh = aggregate.fare_daily_agg(t.landing, t.flights, t.airports, D)
    return merge.agg_upsert(current, fresh)


def q_agg_upsert(spark, base):
    return _round_agg(_agg_upserted(spark, base))


def q_agg_retention(spark, base):
    return _round_agg(merge.retain_recent(_agg_upserted(spark, base), D))


def q_batch_bounds(spark, base):
    return merge.batch_bounds(fixtures.load(spark, base).landing, D)


def q_fare_latest(spark, base):
    return merge.fare_latest(fixtures.load(spark, base).landing)


def q_fare_upsert(spark, base):
    t = fixtures.load(spark, base)
    return merge.migrate_landing(t.fares, t.landing)


def q_fare_migrate(spark, base):
    t = fixtures.load(spark, base)
    return merge.migrate_day(t.fares, t.landing, D)


def q_landing_purge(spark, base):
    return merge.purge_landing(fixtures.load(spark, base).landing, D)


def q_expired_delete(spark, base):
    return merge.delete_departed(fixtures.load(spark, base).flights, D)


# --- archive ------------------------------------------------------------------------------------

def q_routes(spark, base):
    return fixture_routes(spark, base)


def q_business_date(spark, base):
    ev = read_table(spark, base, "events", ["event_id", "ts"])
    return ev.select("event_id", business_date_col("ts").alias("business_date"))


def q_flights_in_window(spark, base):
    t = fixtures.load(spark, base)
    return archive.flights_in_window(t.flights, fixture_routes(spark, base, t.airports))


def q_flights_in_day(spark, base):
    t = fixtures.load(spark, base)
    return archive.flights_in_window(t.flights, fixture_routes(spark, base, t.airports), day=D)


def q_expired_fares(spark, base):
    return _expired(spark, base)[2]


def q_archive_flights(spark, base):
    t, fw, _ = _expired(spark, base)
    return archive.archive_flights(fw, t.airports, t.fares)


def q_archive_options(spark, base):
    return archive.archive_offers(*_archive_inputs(spark, base))


def q_price_history(spark, base):
    return archive.price_history(*_archive_inputs(spark, base))


def _option_days(doc: DataFrame, *keep) -> DataFrame:
    """The prices of documents as rows: one for each option and day, and one for an option without days (or a flight without options)."""
    one = doc.select(*keep, F.explode_outer(F.map_entries("prices")).alias("o"))
    one = one.select(*keep, F.col("o.key").alias("option_id"), *[F.col(f"o.value.metadata.{c}").alias(c) for c in ("seat_class", "airline", "agency", "fare_class")],
                     F.explode_outer("o.value.price_history").alias("d"))
    return one.select("*", "d.*").drop("d")


def q_price_history_doc(spark, base):
    return _option_days(archive.price_history_doc(*_archive_inputs(spark, base)), "air_id", *archive.ROUTE_DAY)


def _segments(spark, base):
    t, fw, _ = _expired(spark, base)
    archived = archive.archived_flights(fw, t.fares)
    return archive.layover_segments(t.layovers, archived, t.flights, t.airports)


def q_layover_segments(spark, base):
    return _segments(spark, base)


def q_layover_doc(spark, base):
    doc = archive.layover_doc(_segments(spark, base))
    return doc.select("air_id", F.posexplode("legs")).select("air_id", (F.col("pos") + 1).alias("place"), "col.*")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fare_daily_agg": q_fare_daily_agg,
    "fare_daily_agg_all": q_fare_daily_agg_all,
    "agg_upsert": q_agg_upsert,
    "agg_retention": q_agg_retention,
    "batch_bounds": q_batch_bounds,
    "fare_latest": q_fare_latest,
    "fare_upsert": q_fare_upsert,
    "fare_migrate": q_fare_migrate,
    "landing_purge": q_landing_purge,
    "expired_delete": q_expired_delete,
    "routes": q_routes,
    "business_date": q_business_date,
    "flights_in_window": q_flights_in_window,
    "flights_in_day": q_flights_in_day,
    "expired_fares": q_expired_fares,
    "archive_flights": q_archive_flights,
    "archive_options": q_archive_options,
    "price_history": q_price_history,
    "price_history_doc": q_price_history_doc,
    "layover_segments": q_layover_segments,
    "layover_doc": q_layover_doc,
}


class _Lost(Exception):
    """Stands for a driver that is lost between two steps of a job."""


def _until(step: str, times: int = 1):
    """Fails at the ``times``-th time that ``step`` is done."""
    seen = []

    def hear(name):
        seen.append(name)
        if name == step and seen.count(step) == times:
            raise _Lost(step)
    return hear


# --- sinks and streaming ------------------------------------------------------------------------

def _written_archive(spark, base) -> tuple[str, T.StructType]:
    """Documents written as packed JSON lines under route/day folders: the folder, and their schema."""
    from faresight.sources import sinks
    t, fw, _ = _expired(spark, base)
    docs = archive.archive_documents(fw, t.airports, t.fares, t.layovers, t.flights)
    path = scratch_path(spark, "archive")
    sinks.write_archive(docs, path, gzip=True)
    return path, docs.drop(*sinks.PARTS).schema


def _document_rows(back: DataFrame) -> DataFrame:
    """Every field of documents: a row for each option and day."""
    names = {"dep_utc": "depart_time(utc)", "dep_local": "depart_time(dep)", "arr_utc": "arrival_time(utc)", "arr_local": "arrival_time(arr)",
             "dep_code": "depart_airport", "arr_code": "arrival_airport", "layover": "is_layover", "journey": "journey_time"}
    leg = lambda x: F.concat_ws("|", *[F.coalesce(x[c].cast("string"), F.lit("null")) for c in (
        "segment_id", "segment_order", "connect_time", "airline", "from", "to", "depart_time_utc", "arrival_time_utc", "duration")])
    legs = F.coalesce(F.array_join(F.transform("layover_info", leg), ";"), F.lit("-"))
    flat = back.select("air_id", "route_key", "window_date", *[F.col(f"flight.`{c}`").alias(n) for n, c in names.items()], legs.alias("legs"), "prices")
    return _option_days(flat, "air_id", "route_key", "window_date", *names, "legs")


def q_archive_sink(spark, base):
    """Write the archive documents, read them back, and list every field: a row for each option and day."""
    from faresight.sources import sinks
    return _document_rows(sinks.read_archive(spark, *_written_archive(spark, base)))


def q_route_documents(spark, base):
    """Write one packed document for each route and day (twice: the second run replaces the files), read them back, and list every field."""
    from faresight.sources import sinks
    t, fw, _ = _expired(spark, base)
    docs = archive.archive_documents(fw, t.airports, t.fares, t.layovers, t.flights)
    path = scratch_path(spark, "route-documents")
    for rows in (docs.where("air_id LIKE '%7'"), docs):
        sinks.write_route_documents(rows, path, gzip=True)
    return _document_rows(sinks.read_route_documents(spark, path, docs))


def q_layover_listing(spark, base):
    """The legs written in order (flight, then place in the journey) and read back with the position of each in the files."""
    from faresight.sources import sinks
    t, fw, _ = _expired(spark, base)
    legs = archive.layover_segments(t.layovers, archive.archived_flights(fw, t.fares), t.flights, t.airports)
    path = scratch_path(spark, "listing")
    sinks.write_listing(legs, path, ["air_id", "layover_order"])
    return sinks.read_listing(spark, path, ["air_id", "layover_order", "segment_id"])


#: Texts of an event's instant as data has them: by event_id % 8, bad ones and none at all among them.
def _instant_texts(ts):
    iso = lambda t, zone="", between="T": F.concat(F.date_format(t, "yyyy-MM-dd"), F.lit(between), F.date_format(t, "HH:mm:ss"), F.lit(zone))
    seoul, delhi = (F.convert_timezone(F.lit("UTC"), F.lit(z), ts) for z in ("Asia/Seoul", "Asia/Kolkata"))
    return [iso(ts, "Z"), iso(seoul, "+09:00"), iso(delhi, "+0530", " "), iso(ts), F.date_format(ts, "yyyy-MM-dd"), F.concat(F.date_format(ts, "yyyy-MM"), F.lit("-32T00:00:00Z")),
            F.lit("n/a"), F.lit(None).cast("string")]


def q_business_date_text(spark, base):
    """Run dates of instants that are ISO text in several forms."""
    ev = read_table(spark, base, "events", ["event_id", "ts"])
    text = F.element_at(F.array(*_instant_texts(F.col("ts"))), (F.col("event_id") % 8 + 1).cast("int"))
    return ev.select("event_id", business_date_of_text(text).alias("business_date"))

def q_archive_text(spark, base):
    """The written lines themselves: fields in order, and nulls written out rather than left away."""
    line = F.col("value")
    times = lambda text: F.size(F.split(line, text, -1)).cast("bigint") - 1
    return spark.read.text(_written_archive(spark, base)[0]).select(
        F.get_json_object(line, "$.air_id").alias("air_id"), F.substring_index(line, ',"depart_time(dep)"', 1).alias("begins"),
        times('"price":null').alias("null_prices"), times('"connect_time":null').alias("null_connections"),
        line.contains('"is_layover":null').alias("null_flag"), line.contains('"layover_info":null').alias("null_legs"))


def q_stream_ingest(spark, base):
    """Land the landing table's rows through the streaming file source (``availableNow``) and read
    the landed rows back. The source files are written from the derived landing table, standing in
    for the crawler's output folder ``{date}/international``."""
    from faresight.streaming import ingest
    t = fixtures.load(spark, base)
    root = scratch_path(spark, "stream")
    src = f"{root}/source/{D}/international"
    t.landing.write.option("maxRecordsPerFile", 50_000).json(src)
    q = ingest.start_ingest(ingest.read_fare_stream(spark, src), f"{root}/landing", f"{root}/checkpoint/{D}",
                            rejects_path=f"{root}/rejects", available_now=True)
    q.awaitTermination()
    return ingest.read_landing(spark, f"{root}/landing").select(
        "batch_id", "air_id", "seat_class", "agt_code", "adult_fare", "fetched_date", "fare_class")


def _landing_columns(spark, path):
    from faresight.streaming import ingest
    return ingest.read_landing(spark, path).select("batch_id", "air_id", "seat_class", "agt_code", "adult_fare", "fetched_date", "fare_class")


def q_stream_idle_stop(spark, base):
    """A processing-time run that stops itself: files are there when it starts, others come while it runs, then none. What it landed."""
    from faresight.streaming import ingest
    t = fixtures.load(spark, base)
    root = scratch_path(spark, "idle")
    src = f"{root}/source/{D}/international"
    late = F.col("batch_id") % 3 == 0
    t.landing.where(~late).write.option("maxRecordsPerFile", 50_000).json(src)
    query = ingest.start_ingest(ingest.read_fare_stream(spark, src), f"{root}/landing", f"{root}/checkpoint/{D}", f"{root}/rejects", trigger="1 second",
                                idle_event_seconds=0.5)
    t.landing.where(late).write.mode("append").option("maxRecordsPerFile", 50_000).json(src)
    ingest.run_until_idle(query, idle_seconds=4, spark=spark)
    return _landing_columns(spark, f"{root}/landing")


def q_stream_restart(spark, base):
    """A run that fails after its second epoch is written and before it is committed, and one more that goes on from the checkpoint:
    what is landed, and how many epochs were written and committed."""
    from pyspark.errors import StreamingQueryException

    from faresight.streaming import ingest
    t = fixtures.load(spark, base)
    root = scratch_path(spark, "restart")
    src, written = f"{root}/source/{D}/international", []
    t.landing.repartition(5).write.json(src)

    def lose_second(epoch):
        written.append(epoch)
        if written == [0, 1]:
            raise _Lost("between write and commit")

    for attempt in (1, 2):
        query = ingest.start_ingest(ingest.read_fare_stream(spark, src, max_files=2), f"{root}/landing", f"{root}/checkpoint/{D}", f"{root}/rejects",
                                    available_now=True, after_write=lose_second)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if attempt == 2:
                raise
    rows = ingest.read_landing(spark, f"{root}/landing")
    return rows.select("batch_id", "air_id", "seat_class", "agt_code", "adult_fare", "fetched_date", "fare_class",
                       F.lit(",".join(map(str, written))).alias("epochs_written"), F.col("epoch_id").between(0, 2).alias("committed"))


def q_landing_lifecycle(spark, base):
    """Two ingest runs into one landing table (the second brings late rows of the first's dates), then migration and purge of the
    run date on the stored tables: what is left in landing, the fare table, and the counts that the steps report."""
    from faresight.plans import merge_job
    from faresight.streaming import ingest
    t = fixtures.load(spark, base)
    root = scratch_path(spark, "lifecycle")
    stored = merge_job.Tables(*[f"{root}/{n}" for n in ("airports", "flights", "fares", "landing", "agg")])
    t.fares.hint("rebalance", "fetched_date").write.partitionBy("fetched_date").parquet(stored.fares)
    late = F.coalesce(F.col("fetched_date") > F.lit(D).cast("date"), F.lit(False)) | (F.col("batch_id") % 10 == 3)
    for run, rows in (("2024-01-28", t.landing.where(~late)), ("2024-01-29", t.landing.where(late))):
        src = f"{root}/source/{run}/international"
        rows.write.json(src)
        ingest.start_ingest(ingest.read_fare_stream(spark, src), stored.landing, f"{root}/checkpoint/{run}", f"{root}/rejects",
                            available_now=True).awaitTermination()
    _, upserted = merge_job.migrate(spark, stored, D)
    _, purged = merge_job.purge(spark, stored, D)
    columns = ["batch_id", *FARE_COLUMNS]
    left = ingest.read_landing(spark, stored.landing).select(F.lit("landing").alias("part"), *columns)
    fares = spark.read.schema(left.select(*FARE_COLUMNS).schema).parquet(stored.fares) \
        .select(F.lit("fares").alias("part"), F.lit(None).cast("bigint").alias("batch_id"), *FARE_COLUMNS)
    counts = spark.createDataFrame([("upserted", upserted), ("purged", purged)], "part string, batch_id bigint") \
        .select("*", *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in FARE_COLUMNS])
    return left.unionByName(fares).unionByName(counts)


def q_landing_race(spark, base):
    """Ingest goes on while the daily merge runs: one more epoch of the run date lands between migration and purge, and another purge
    follows. What is left in landing, the fare table, and the counts that the steps report."""
    from faresight.plans import merge_job
    from faresight.streaming import ingest
    t = fixtures.load(spark, base)
    root = scratch_path(spark, "race")
    stored = merge_job.Tables(*[f"{root}/{n}" for n in ("airports", "flights", "fares", "landing", "agg")])
    t.fares.hint("rebalance", "fetched_date").write.partitionBy("fetched_date").parquet(stored.fares)
    late = F.col("batch_id") % 5 == 2
    src = f"{root}/source/{D}/international"

    def land(rows):
        rows.write.mode("append").json(src)
        ingest.start_ingest(ingest.read_fare_stream(spark, src), stored.landing, f"{root}/checkpoint/{D}", f"{root}/rejects", available_now=True).awaitTermination()

    land(t.landing.where(~late))
    _, upserted = merge_job.migrate(spark, stored, D)
    land(t.landing.where(late))
    counts = {"upserted": upserted, "purged": merge_job.purge(spark, stored, D)[1], "purged again": merge_job.purge(spark, stored, D)[1]}
    columns = ["batch_id", *FARE_COLUMNS]
    left = ingest.read_landing(spark, stored.landing).select(F.lit("landing").alias("part"), *columns)
    fares = spark.read.schema(left.select(*FARE_COLUMNS).schema).parquet(stored.fares) \
        .select(F.lit("fares").alias("part"), F.lit(None).cast("bigint").alias("batch_id"), *FARE_COLUMNS)
    said = spark.createDataFrame(list(counts.items()), "part string, batch_id bigint") \
        .select("*", *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in FARE_COLUMNS])
    return left.unionByName(fares).unionByName(said)


def q_expired_delete_resumed(spark, base):
    """The flight delete, interrupted after each of its steps and run again: the table that is then there, for each, and a run that
    finds all done."""
    from pyspark.sql import Observation

    from faresight.sources import sinks
    flights = fixtures.load(spark, base).flights.coalesce(3)
    out = None
    for step, times in (("written", 1), ("noted", 1), ("moved", 1), ("moved", 2), ("marked", 1)):
        path = f"{scratch_path(spark, 'resumed')}/flights"
        counts = []
        for fails in (True, False, False):
            seen = Observation()
            left = merge.delete_departed(flights, D, observation=seen)
            try:
                counts.append(sinks.publish_snapshot(left, path, D, [seen], _until(step, times) if fails else None))
            except _Lost:
                pass
        same = counts[0] == counts[1]
        rows = spark.read.parquet(path).select(F.lit(f"{step} {times}").alias("interrupted"), F.lit(counts[0]["removed"]).cast("bigint").alias("removed"),
                                               F.lit(same).alias("same_counts"), *flights.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


def q_job_counts(spark, base):
    """What the archive, the flight delete, the retention and the landing purge of the run date say they wrote and removed. Every
    job is run a second time, the flight delete after an interruption."""
    from faresight.plans import archive_job, merge_job
    t = fixtures.load(spark, base)
    root = scratch_path(spark, "counts")
    said = []
    for attempt in (1, 2):
        try:
            job = archive_job.run_archive(spark, t.flights, t.airports, t.fares, t.layovers, fixture_routes(spark, base, t.airports), D, f"{root}/archive",
                                          f"{root}/flights-next", step=_until("noted") if attempt == 1 else None)
            said += [("archive", name, n) for name, n in job.counts.items()] + [("archive", "removed unarchived", job.removed_unarchived)]
        except _Lost:
            pass
    stored = merge_job.Tables(*[f"{root}/{n}" for n in ("airports", "flights", "fares", "landing", "agg")])
    t.airports.write.parquet(stored.airports)
    t.flights.write.parquet(stored.flights)
    for rows, path in ((t.fares, stored.fares), (t.landing, stored.landing), (aggregate.fare_daily_agg(t.fares, t.flights, t.airports), stored.agg)):
        rows.hint("rebalance", "fetched_date").write.partitionBy("fetched_date").parquet(path)
    for attempt in (1, 2):
        counts = merge_job.run_daily_merge(spark, stored, D).counts
        said += [(f"merge {attempt}", name, counts[name]) for name in ("agg_upserted", "agg_removed", "fare_upserted", "landing_removed")]
    return spark.createDataFrame(said, "job string, counted string, n bigint")


QUERIES["archive_sink"] = q_archive_sink
QUERIES["archive_text"] = q_archive_text
QUERIES["stream_ingest"] = q_stream_ingest
QUERIES["landing_lifecycle"] = q_landing_lifecycle
QUERIES["landing_race"] = q_landing_race
QUERIES["expired_delete_resumed"] = q_expired_delete_resumed
QUERIES["job_counts"] = q_job_counts
QUERIES["route_documents"] = q_route_documents
QUERIES["layover_listing"] = q_layover_listing
QUERIES["business_date_text"] = q_business_date_text
QUERIES["stream_idle_stop"] = q_stream_idle_stop
QUERIES["stream_restart"] = q_stream_restart
