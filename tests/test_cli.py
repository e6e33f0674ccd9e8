"""The spark-submit entry points, run in-process on copies of the sf0.001 tables."""

from faresight.plans import cli
from faresight.session import scratch_path
from faresight.sources import region_map
from test_plans import _copy_tables

D = "2024-01-28"


def test_daily_merge_command(spark, tables, oracle_count):
    t = _copy_tables(spark, tables)
    out = cli.main(["daily-merge", "--airports", t.airports, "--flights", t.flights, "--fares", t.fares,
                    "--landing", t.landing, "--agg", t.agg, "--logical-date", "2024-01-27T00:00:00Z"],
                   spark=spark)
    assert out["day"] == D and out["landing_removed"] == tables.landing.count() - oracle_count("landing_purge")
    assert spark.read.parquet(out["agg"]).count() == oracle_count("agg_retention")


def test_archive_command(spark, tables, oracle_count):
    t = _copy_tables(spark, tables)
    tables.layovers.write.parquet(t.flights + "-layovers")
    rmap = scratch_path(spark, "cli-rmap")
    region_map.write_region_map(tables.airports, rmap)
    out = cli.main(["archive", "--airports", t.airports, "--flights", t.flights, "--fares", t.fares,
                    "--layovers", t.flights + "-layovers", "--region-map", rmap,
                    "--out", scratch_path(spark, "cli-archive"), "--flights-out", scratch_path(spark, "cli-flights"), "--day", D,
                    "--departures", "A00,A01,A02", "--arrivals", "A03,A04,A05,A06", "--regions", ""],
                   spark=spark)
    assert out["removed"] == tables.flights.count() - oracle_count("expired_delete") and out["archived"] == out["removed"] - out["removed_unarchived"]
    assert spark.read.parquet(out["flights"]).count() == oracle_count("expired_delete")


def test_ingest_command(spark, tables):
    root = scratch_path(spark, "cli-ingest")
    tables.landing.repartition(3).write.json(f"{root}/src")
    out = cli.main(["ingest", "--source", f"{root}/src", "--landing", f"{root}/landing",
                    "--checkpoint", f"{root}/ckpt", "--rejects", f"{root}/rejects", "--available-now", "--max-files", "2"], spark=spark)
    assert out["rows"] == tables.landing.count() and out["batches"] == 2 and out["rejects"] == 0
