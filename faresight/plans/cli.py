"""Job entry points for spark-submit: ``archive``, ``daily-merge`` and ``ingest``.

    spark-submit faresight/plans/cli.py daily-merge --airports P --flights P --fares P --landing P \\
        --agg P --day D
    spark-submit faresight/plans/cli.py archive --airports P --flights P --fares P --layovers P \\
        --region-map P --out P --logical-date 2024-01-27T15:00:00Z
    spark-submit faresight/plans/cli.py ingest --source P --landing P --checkpoint P --rejects P --idle-stop 30

(``python -m faresight.plans.cli …`` works the same with a local session.)

The run date is ``--day`` (a business date) or ``--logical-date`` (scheduler instant: + 1 day, in Seoul).
Each command prints one JSON line with its counts and output folders.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from faresight.constants import (BUSINESS_ZONE, MAX_FILES_PER_TRIGGER, REFERENCE_ARRIVAL_REGIONS,
                                 REFERENCE_DEPARTURES, REFERENCE_EXTRA_ARRIVALS, TRIGGER_INTERVAL)
from faresight.functions.time import run_date


def _day(a) -> str:
    if a.day:
        return a.day
    if a.logical_date:
        return run_date(a.logical_date, BUSINESS_ZONE).isoformat()
    raise SystemExit("give --day or --logical-date")


def _csv(v: str) -> list[str]:
    return [x for x in v.split(",") if x]


def cmd_daily_merge(spark: SparkSession, a) -> dict:
    from faresight.plans.merge_job import Tables, run_daily_merge
    t = Tables(a.airports, a.flights, a.fares, a.landing, a.agg)
    res = run_daily_merge(spark, t, _day(a), agg_exists=not a.first_run)
    counts = {k: [str(x) for x in v] if isinstance(v, list) else v for k, v in res.counts.items()}
    return {"day": _day(a), "agg": res.tables.agg, "landing": res.tables.landing, **counts}


def cmd_archive(spark: SparkSession, a) -> dict:
    from faresight.operators.routes import routes
    from faresight.plans.archive_job import run_archive
    from faresight.sources.region_map import read_region_map
    rd = spark.read.parquet
    r = routes(read_region_map(spark, a.region_map), _csv(a.departures), _csv(a.arrivals), _csv(a.regions))
    res = run_archive(spark, rd(a.flights), rd(a.airports), rd(a.fares), rd(a.layovers), r, _day(a), a.out,
                      a.flights_out, a.zone)
    return {"day": _day(a), "archive": res.archive_path, "flights": res.flights_path, "archived": res.archived,
            "removed": res.removed, "removed_unarchived": res.removed_unarchived}


def cmd_ingest(spark: SparkSession, a) -> dict:
    from faresight.streaming import ingest
    stream, landed = ingest.read_fare_stream(spark, a.source, max_files=a.max_files), ingest.Landed()
    q = ingest.start_ingest(stream, a.landing, a.checkpoint, a.rejects, run=a.run, trigger=a.trigger,
                            available_now=a.available_now, landed=landed)
    if a.available_now:
        q.awaitTermination()
    else:
        ingest.run_until_idle(q, idle_seconds=a.idle_stop, max_seconds=a.max_seconds)
    return {"landing": a.landing, "batches": landed.batches, "rows": landed.rows, "rejects": landed.rejects}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="faresight")
    sub = p.add_subparsers(dest="cmd", required=True)

    def dated(sp):
        sp.add_argument("--day")
        sp.add_argument("--logical-date")

    m = sub.add_parser("daily-merge")
    for f in ("airports", "flights", "fares", "landing", "agg"):
        m.add_argument(f"--{f}", required=True)
    m.add_argument("--first-run", action="store_true", help="the aggregate table does not exist yet")
    dated(m)

    ar = sub.add_parser("archive")
    for f in ("airports", "flights", "fares", "layovers", "region-map", "out", "flights-out"):
        ar.add_argument(f"--{f}", required=True)
    ar.add_argument("--departures", default=",".join(REFERENCE_DEPARTURES))
    ar.add_argument("--arrivals", default=",".join(REFERENCE_EXTRA_ARRIVALS))
    ar.add_argument("--regions", default=",".join(REFERENCE_ARRIVAL_REGIONS))
    ar.add_argument("--zone", default=BUSINESS_ZONE)
    dated(ar)

    i = sub.add_parser("ingest")
    for f in ("source", "landing", "checkpoint", "rejects"):
        i.add_argument(f"--{f}", required=True)
    i.add_argument("--run", help="name of the run in the landing table (default: last part of the checkpoint's path)")
    i.add_argument("--max-files", type=int, default=MAX_FILES_PER_TRIGGER)
    i.add_argument("--trigger", default=TRIGGER_INTERVAL)
    i.add_argument("--idle-stop", type=float, default=30.0, help="seconds without input before stopping")
    i.add_argument("--max-seconds", type=float, default=82800.0)
    i.add_argument("--available-now", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    if spark is None:
        from faresight.session import build_session
        spark = build_session()
    out = {"daily-merge": cmd_daily_merge, "archive": cmd_archive, "ingest": cmd_ingest}[a.cmd](spark, a)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
