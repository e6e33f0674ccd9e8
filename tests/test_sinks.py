"""Region map source, archive JSON sink, partition overwrite."""

import json
import os

import pytest
from pyspark.sql import functions as F

from faresight.constants import REFERENCE_ARRIVAL_REGIONS, REFERENCE_DEPARTURES, REFERENCE_EXTRA_ARRIVALS
from faresight.operators.routes import routes
from faresight.session import local_path, scratch_path
from faresight.sources import region_map, sinks


def test_region_map_with_bom_roundtrip(spark, tables):
    path = scratch_path(spark, "rmap")
    region_map.write_region_map(tables.airports, path)
    raw = open(local_path([p for p in __import__("glob").glob(local_path(path) + "/part-*")][0]), "rb").read()
    assert raw.startswith("﻿".encode())
    rows = region_map.read_region_map(spark, path)
    assert rows.count() == 25
    assert rows.select("region").distinct().count() == 5


def test_routes_like_the_archive_job(spark):
    """Departures x (extra arrivals, in the map or not, + all airports of the listed regions), both directions."""
    path = local_path(scratch_path(spark, "rmap-ref"))
    import os
    os.makedirs(path)
    doc = {"home": [{"도시": "c2", "IATA": "SEL", "공항명": "n2"}],
           "일본": [{"도시": "c3", "IATA": "KIX", "공항명": "n3"}],
           "유럽": [{"도시": "c4", "IATA": "CDG", "공항명": "n4"}, {"도시": "c5", "IATA": "LHR", "공항명": "n5"}]}
    with open(f"{path}/map.json", "w", encoding="utf-8-sig") as f:
        json.dump(doc, f, ensure_ascii=False)
    ra = region_map.read_region_map(spark, path)
    r = routes(ra, REFERENCE_DEPARTURES, REFERENCE_EXTRA_ARRIVALS, REFERENCE_ARRIVAL_REGIONS)
    got = sorted((x.depart_airport, x.arrival_airport) for x in r.collect())
    arr = ["CDG", "CJU", "KIX", "LHR"]
    want = sorted([(d, a) for d in REFERENCE_DEPARTURES for a in arr] +
                  [(a, d) for d in REFERENCE_DEPARTURES for a in arr])
    assert got == want


def test_archive_json_keeps_nulls_and_text(spark):
    from faresight.plans import catalog
    path = scratch_path(spark, "arch-test")
    t, fw, _ = catalog._expired(spark, "/root/testdata/sf0.001")
    from faresight.operators import archive
    docs = archive.archive_documents(fw, t.airports, t.fares, t.layovers, t.flights)
    sinks.write_archive(docs, path)
    files = __import__("glob").glob(local_path(path) + "/route_key=*/window_date=*/*.json")
    assert files
    line = open(files[0], encoding="utf-8").readline()
    doc = json.loads(line)
    assert set(doc) == {"air_id", "flight", "prices", "layover_info"}
    assert doc["flight"]["is_layover"] in ("True", "False")
    text = "".join(open(f, encoding="utf-8").read() for f in files)
    assert '"price":null' in text and "is_available" in text
    back = spark.read.json(path)
    assert back.count() == docs.count() > 700


def test_overwrite_partitions_touches_only_listed(spark):
    path = scratch_path(spark, "pow")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    base.write.partitionBy("p").parquet(path)
    sinks.overwrite_partitions(spark.createDataFrame([(9, "a")], "v int, p string"), path, "p")
    got = sorted((r.v, r.p) for r in spark.read.parquet(path).collect())
    assert got == [(2, "b"), (9, "a")]


def test_ordered_leg_rows(spark, tables, oracle_count):
    from faresight.operators import archive
    from faresight.plans import catalog
    t, fw, _ = catalog._expired(spark, "/root/testdata/sf0.001")
    rows = archive.layover_segments(t.layovers, archive.archived_flights(fw, t.fares), t.flights, t.airports,
                                    ordered=True).select("air_id", "layover_order").collect()
    keys = [(r.air_id, r.layover_order) for r in rows]
    assert keys == sorted(keys) and len(keys) == oracle_count("layover_segments")


def _documents(spark):
    from faresight.operators import archive
    from faresight.plans import catalog
    t, fw, _ = catalog._expired(spark, "/root/testdata/sf0.001")
    return archive.archive_documents(fw, t.airports, t.fares, t.layovers, t.flights)


def test_route_documents_are_whole_json_files(spark):
    path = scratch_path(spark, "route-docs")
    docs = _documents(spark)
    wanted = {f"{r.route_key}/{r.window_date}.json": r.n for r in docs.groupBy("route_key", "window_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(sinks.write_route_documents(docs, path)) == sorted(wanted)
    legs = 0
    for name, n in wanted.items():
        with open(f"{local_path(path)}/{name}", encoding="utf-8") as f:
            text = f.read()
        doc = json.loads(text)
        assert list(doc) == ["flights", "prices", "layover_info"] and list(doc["flights"]) == sorted(doc["flights"]) == list(doc["prices"])
        assert len(doc["flights"]) == n and set(doc["layover_info"]) <= set(doc["flights"]) and text.count("\n") == 2 * n + len(doc["layover_info"])
        legs += len(doc["layover_info"])
    assert legs and [x for x in os.listdir(local_path(path)) if x.startswith("_")] == []
    # Another run replaces the documents that it has and leaves the others.
    some = next(iter(wanted)).split("/")[0]
    assert sinks.write_route_documents(docs.where(F.col("route_key") == some).limit(1), path) != []
    assert sorted(p for p in sinks.Store(spark, path).files(path) if not p.endswith(".crc")) == sorted(wanted)
    assert sinks.write_route_documents(docs.limit(0), scratch_path(spark, "none")) == []


def test_a_snapshot_is_finished_and_never_mixed(spark):
    from pyspark.sql import Observation
    path, df = scratch_path(spark, "snap") + "/t", spark.range(10)
    seen = Observation()
    assert sinks.publish_snapshot(df.observe(seen, F.count(F.lit(1)).alias("n")), path, "a", [seen]) == {"n": 10}
    assert sinks.publish_snapshot(spark.range(99), path, "a") == {"n": 10} and spark.read.parquet(path).count() == 10
    for other in (path, scratch_path(spark, "taken")):
        df.write.mode("append").parquet(other)
        with pytest.raises(FileExistsError):
            sinks.publish_snapshot(df, other, "b")
    # Left over from a run that was lost while it wrote: written anew, with what the next run has.
    path = scratch_path(spark, "lost") + "/t"
    df.write.parquet(path.removesuffix("/t") + "/_t-a")
    assert sinks.publish_snapshot(spark.range(3), path, "a") == {} and spark.read.parquet(path).count() == 3
    assert sinks.publish_snapshot(spark.range(0).observe(none := Observation(), F.count(F.lit(1)).alias("n")), path + "0", "a", [none]) in ({}, {"n": 0})


def test_listing_positions_follow_the_keys_over_files(spark):
    path = scratch_path(spark, "listing")
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("v"))
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_listing(rows, path, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)
    assert len([f for f in sinks.Store(spark, path).names(path) if f.endswith(".parquet")]) > 3
    assert all(r.position == r.k + 1 for r in sinks.read_listing(spark, path, ["k"]).collect())


def test_flights_are_selected_by_route_where_they_are_scanned(spark, tables):
    """No exchange of flights for a bounded route list; a longer one is left to the planner."""
    import re
    from faresight.operators import archive
    from faresight.operators.routes import bounded
    from faresight.plans.catalog import fixture_routes
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fixed = archive.flights_in_window(tables.flights, fixture_routes(spark, "/root/testdata/sf0.001"))
        many = spark.range(100).selectExpr("cast(id as string) depart_airport", "'x' arrival_airport")
        plans = [archive.flights_in_window(tables.flights, r)._jdf.queryExecution().executedPlan().toString()
                 for r in (fixture_routes(spark, "/root/testdata/sf0.001"), bounded(many, 100), bounded(many, 99))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert fixed.count() > 500
    for plan in plans[:2]:
        assert "BroadcastHashJoin" in plan and not re.search(r"Exchange hashpartitioning\(depart_airport[^\n]*\n[^\n]*FileScan parquet", plan)
    assert "SortMergeJoin" in plans[2]


def test_route_documents_are_read_by_entry(spark):
    """A file is split between tasks and its entries meet again by flight, whatever their names and texts hold."""
    docs = _documents(spark)
    odd = docs.limit(20).withColumn("air_id", F.concat(F.lit('},"pri\\ces":{ '), "air_id"))
    docs = spark.createDataFrame(docs.unionByName(odd).collect(), docs.schema)
    path = scratch_path(spark, "by-entry")
    files = len(sinks.write_route_documents(docs, path))
    size, cost = (spark.conf.get(f"spark.sql.files.{c}") for c in ("maxPartitionBytes", "openCostInBytes"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        back = sinks.read_route_documents(spark, path, docs)
        assert spark.read.text(f"{path}/*/*.json").rdd.getNumPartitions() > files
        got, want = (sorted((r.asDict(True) for r in rows.select(docs.columns).collect()), key=lambda r: r["air_id"]) for rows in (back, docs))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == want and any(r["layover_info"] for r in want) and any(not r["prices"] for r in want)


def _shuffle_files(spark):
    """Names of the shuffle files that are on disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are there beside those of ``before``, when Spark has had time to drop them."""
    import time
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return _shuffle_files(spark) - before


def _texts(path):
    import gzip
    import re
    found = {}
    for where, _, names in os.walk(local_path(path)):
        for n in (n for n in names if n.endswith((".json", ".json.gz"))):
            with (gzip.open if n.endswith(".gz") else open)(f"{where}/{n}", "rt", encoding="utf-8") as f:
                found.setdefault(os.path.relpath(where, local_path(path)) + "/" + re.sub(r"part-.*?json", "part.json", n), []).append(f.read())
    return found


def _size(path):
    return sum(os.path.getsize(f"{where}/{n}") for where, _, names in os.walk(local_path(path)) for n in names if ".json" in n and not n.endswith(".crc"))


def test_packed_route_documents_hold_the_same_text_and_replace_plain_ones(spark):
    docs, plain, packed = _documents(spark), scratch_path(spark, "plain-docs"), scratch_path(spark, "packed-docs")
    sinks.write_route_documents(docs, plain)
    sinks.write_route_documents(docs.where("air_id LIKE '%7'"), packed)
    before = _shuffle_files(spark)
    names = sinks.write_route_documents(docs, packed, gzip=True)
    assert _left(spark, before) == set()
    texts = _texts(plain)
    assert {n + ".gz": t for n, t in texts.items()} == _texts(packed) and sorted(names) == sorted(_texts(packed)) and _size(packed) * 5 < _size(plain)
    back, want = (sorted((r.asDict(True) for r in sinks.read_route_documents(spark, p, docs).select(docs.columns).collect()), key=lambda r: r["air_id"]) for p in (packed, plain))
    assert back == want and len(back) == docs.count()
    assert sorted(sinks.write_route_documents(docs, packed)) == sorted(texts) and _texts(packed) == texts


def test_packed_archive_has_the_same_lines_and_documents(spark):
    docs, plain, packed = _documents(spark), scratch_path(spark, "plain-lines"), scratch_path(spark, "packed-lines")
    sinks.write_archive(docs, plain)
    before = _shuffle_files(spark)
    sinks.write_archive(docs, packed, gzip=True)
    assert _left(spark, before) == set() and all(n.endswith(".json.gz") for n in _texts(packed)) and _size(packed) * 5 < _size(plain)
    lines = lambda path: {n.removesuffix(".gz"): sorted("".join(t).splitlines()) for n, t in _texts(path).items()}
    assert lines(packed) == lines(plain) and sum(map(len, lines(plain).values())) == docs.count()
    schema = docs.drop(*sinks.PARTS).schema
    back, want = (sorted((r.asDict(True) for r in sinks.read_archive(spark, p, schema).collect()), key=lambda r: r["air_id"]) for p in (packed, plain))
    assert back == want
    # A route-day that is written again is replaced, whichever form it had.
    sinks.write_archive(docs, packed)
    assert lines(packed) == lines(plain) and _texts(packed).keys() == _texts(plain).keys()


def test_written_lines_are_read_from_packed_files(spark):
    """What archive_sink and archive_text read: small files that hold each document's line as the plain ones do."""
    from faresight.plans import catalog
    path, schema = catalog._written_archive(spark, "/root/testdata/sf0.001")
    docs, plain = _documents(spark), scratch_path(spark, "plain-text")
    sinks.write_archive(docs, plain)
    assert schema == docs.drop(*sinks.PARTS).schema and _size(path) * 5 < _size(plain)
    got, want = (sorted(r.value for r in spark.read.text(p).collect()) for p in (path, plain))
    assert got == want and len(got) == docs.count()


def test_histories_are_not_shuffled_before_they_are_written(spark, tables):
    """Documents of tables that lie by flight: only legs, which come from their segments' places, are dealt out by flight."""
    import re
    from faresight.operators import archive
    from faresight.plans.catalog import fixture_routes
    from faresight.sources import fixtures
    t = fixtures.read_tables(spark, fixtures.write_tables(tables, scratch_path(spark, "by-flight"), 4, "by_flight"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    try:
        fw = archive.flights_in_window(t.flights, fixture_routes(spark, "/root/testdata/sf0.001"))
        docs = archive.archive_documents(fw, t.airports, t.fares, t.layovers, t.flights)
        plan = docs._jdf.queryExecution().executedPlan().toString()
        rows = docs.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert re.findall(r"Exchange hashpartitioning\(air_id#\d+, (.*?)\)", plan) == ["4"]
    assert sorted(rows, key=lambda r: r.air_id) == sorted(_documents(spark).collect(), key=lambda r: r.air_id)


def test_a_flight_number_of_two_days_has_the_prices_of_each(spark, tables):
    from faresight.operators import archive
    from faresight.plans.catalog import fixture_routes
    from faresight.sources import fixtures
    number = tables.fares.where("air_id IS NOT NULL").join(tables.flights.where("depart_airport = 'A00' AND arrival_airport = 'A03'"), "air_id", "left_semi").first().air_id
    flights = tables.flights.where(F.col("air_id") == number)
    twice = flights.unionByName(flights.withColumns({c: F.col(c) + F.expr("INTERVAL 3 DAYS") for c in ("depart_timestamp", "arrival_timestamp")}))
    fw = archive.flights_in_window(twice, fixture_routes(spark, "/root/testdata/sf0.001"))
    docs = archive.archive_documents(fw, tables.airports, tables.fares, tables.layovers, twice)
    days = {r.window_date for r in fw.collect()}
    prices = archive.price_history_doc(archive.expired_fares(fw, tables.airports, tables.fares), archive.frame_max(fw, tables.airports, tables.fares))
    want = {r.window_date: r.prices for r in prices.collect()}
    assert len(days) == 2 and {r.window_date for r in docs.collect()} == days and docs.count() == 2
    assert all(r.prices == want.get(r.window_date, {}) for r in docs.collect())


def test_tables_are_built_without_leaving_shuffles_or_staged_rows(spark, tables):
    from faresight.session import shared_dir
    from faresight.sources import fixtures
    before = _shuffle_files(spark)
    again = fixtures.load(spark, "/root/testdata/sf0.001/")
    assert _left(spark, before) == set()
    assert [n for n in os.listdir(local_path(shared_dir(spark))) if n.startswith("fare-raw")] == []
    assert again.fares is not tables.fares
    for name in ("fares", "landing", "flights", "layovers"):
        one, other = getattr(again, name), getattr(tables, name)
        assert one.schema == other.schema and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_counts_that_never_come_are_counted_again(spark):
    from pyspark.sql import Observation
    lost = Observation()
    spark.range(3).observe(lost, F.count(F.lit(1)).alias("n"))       # no action reports it
    assert sinks.observed(lost, recount=lambda: {"n": 3}, seconds=0.2) == {"n": 3}
    lost = Observation()
    spark.range(3).observe(lost, F.count(F.lit(1)).alias("n"))
    with pytest.raises(TimeoutError):
        sinks.observed(lost, seconds=0.2)


def test_partitions_have_files_by_their_size(spark):
    path = scratch_path(spark, "few-files")
    sinks.overwrite_partitions(spark.range(1000).repartition(16).withColumn("p", F.col("id") % 3), path, "p")
    files = [f for f in sinks.Store(spark, path).files(path) if f.endswith(".parquet")]
    assert len(files) == 3 and spark.read.parquet(path).count() == 1000


def test_tables_have_files_by_their_size():
    from faresight.sources.fixtures import bucket_count
    assert bucket_count(0, 8) == bucket_count(6_000, 8) == 1 and bucket_count(600_000, 8) == 8
    assert bucket_count(216_000_000, 12) == 216
