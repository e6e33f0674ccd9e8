"""Stream ingest: crawled fare files -> landing table, in bounded micro-batches.

- file source with an explicit schema; malformed lines go to a rejects table (never dropped silently)
- ``maxFilesPerTrigger`` bounds each micro-batch (60 files), processing-time trigger (1 minute)
- landing rows lie under ``fetched_date=D/run=R/epoch_id=N``: daily reads prune by date, a purge removes
  whole ``fetched_date`` folders, and ingest, merge and purge share one table. ``foreachBatch`` overwrites just
  the folders of its own run and epoch, so a replayed epoch (after a failure between write and commit)
  replaces its own output and never another run's
- landing rows carry the order they came in: run, epoch, file time, file path and position. With the
  record's ``batch_id`` (when the files carry one) these order rows for latest-wins merging
- one checkpoint per run; a restart resumes from the checkpoint and adds nothing already landed
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from faresight.constants import MAX_FILES_PER_TRIGGER, TRIGGER_INTERVAL

CORRUPT = "_corrupt_record"

# Landing schema of crawled fare records (the file format of the crawler is not specified; these are
# the columns the landing table needs).
FARE_RECORD = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("air_id", T.StringType()),
    T.StructField("seat_class", T.StringType()),
    T.StructField("agt_code", T.StringType()),
    T.StructField("adult_fare", T.IntegerType()),
    T.StructField("fetched_date", T.DateType()),
    T.StructField("fare_class", T.StringType()),
])


def read_fare_stream(spark: SparkSession, path: str, schema: T.StructType = FARE_RECORD,
                     max_files: int = MAX_FILES_PER_TRIGGER, fmt: str = "json",
                     path_glob: str | None = None) -> DataFrame:
    """Streaming DataFrame over the files under ``path`` with file metadata columns."""
    full = schema
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.schema(full).format(fmt).load(path)
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_modification_time").alias("file_modification_time"))


ARRIVAL = ("run", "epoch_id", "file_modification_time", "source_file", "position")


@dataclass
class Landed:
    """What a query has landed so far, counted batch by batch as it is written."""
    batches: int = 0
    rows: int = 0
    rejects: int = 0


def _landing_writer(landing_path: str, rejects_path: str, run: str, columns: list[str],
                    partition_col: str = "fetched_date", landed: Landed | None = None, after_write: Callable[[int], None] | None = None):
    def write(batch: DataFrame, epoch_id: int) -> None:
        b = batch.withColumns({"run": F.lit(run), "epoch_id": F.lit(epoch_id).cast("bigint"),
                               "position": F.monotonically_increasing_id()})
        has_corrupt = CORRUPT in batch.columns
        if has_corrupt:
            b = b.persist()
        good = b.where(F.col(CORRUPT).isNull()) if has_corrupt else b
        bad = b.where(F.col(CORRUPT).isNotNull()).count() if has_corrupt else 0
        parts = [c for c in (partition_col, "run", "epoch_id") if c in good.columns]
        # Rows meet by date, so an epoch has a file or few for each date, not one for each date and source file.
        (good.select(*columns, *ARRIVAL).hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(landing_path))
        if bad:
            (b.where(F.col(CORRUPT).isNotNull())
             .select(CORRUPT, "source_file", "file_modification_time", "run", "epoch_id")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run", "epoch_id").parquet(rejects_path))
        if landed is not None:
            landed.batches += 1
            landed.rows += good.count()
            landed.rejects += bad
        if has_corrupt:
            b.unpersist()
        if after_write is not None:
            after_write(epoch_id)
    return write


def start_ingest(stream: DataFrame, landing_path: str, checkpoint: str, rejects_path: str, run: str | None = None,
                 columns: list[str] | None = None, trigger: str | None = TRIGGER_INTERVAL,
                 available_now: bool = False, name: str | None = None, partition_col: str = "fetched_date",
                 landed: Landed | None = None, after_write: Callable[[int], None] | None = None, idle_event_seconds: float = 1.0) -> StreamingQuery:
    """Start the landing query; ``available_now`` drains what is there and stops (tests, backfills).

    ``run`` names the run in the landing table: the run date, or what else the checkpoint belongs to (its last
    path component, unless given). A new checkpoint numbers its epochs from 0 again, so it needs a
    run of its own. Malformed lines go to ``rejects_path``. ``landed`` is filled with the true counts. ``after_write`` is called
    with the number of each epoch when it is written and before it is committed: should it fail, the query fails, and
    a restart replays that epoch over its own output. A query without input says so every ``idle_event_seconds`` at most.
    """
    cols = columns or [f.name for f in FARE_RECORD.fields]
    run = run or checkpoint.rstrip("/").rsplit("/", 1)[-1]
    w = (stream.writeStream.foreachBatch(_landing_writer(landing_path, rejects_path, run, cols, partition_col, landed, after_write))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    conf, before = stream.sparkSession.conf, stream.sparkSession.conf.get(IDLE_EVENTS)
    conf.set(IDLE_EVENTS, f"{int(1000 * idle_event_seconds)}ms")          # a query keeps the settings of its start
    try:
        return w.start()
    finally:
        conf.set(IDLE_EVENTS, before)


IDLE_EVENTS = "spark.sql.streaming.noDataProgressEventInterval"


class IdleWatch(StreamingQueryListener):
    """Sets ``done`` when the query of ``run_id`` has had no input for ``idle_seconds``, or has ended.

    It goes by the query's own events: a batch with input reports its progress when it ends, a trigger that found
    nothing reports that the query is idle. While a batch runs there is neither, so it is never taken for idle
    however long it takes; the clock starts with the last batch that had input.
    """

    def __init__(self, run_id: str, idle_seconds: float, clock: Callable[[], float] = time.monotonic) -> None:
        self.run_id, self.idle_seconds, self.clock = str(run_id), idle_seconds, clock
        self.done, self.last_input, self.rows = threading.Event(), clock(), 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self.run_id:
            if event.progress.numInputRows > 0:
                self.last_input, self.rows = self.clock(), self.rows + event.progress.numInputRows
            else:
                self._idle()

    def onQueryIdle(self, event) -> None:
        if str(event.runId) == self.run_id:
            self._idle()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.done.set()

    def _idle(self) -> None:
        if self.clock() - self.last_input >= self.idle_seconds:
            self.done.set()


def run_until_idle(query: StreamingQuery, idle_seconds: float, max_seconds: float | None = None, spark: SparkSession | None = None) -> int:
    """Stop ``query`` once it has had no input for ``idle_seconds`` (or after ``max_seconds``); returns the rows it read meanwhile.

    What the query says of itself decides (:class:`IdleWatch`), not a poll of its status. A query that fails raises here.
    """
    watch = IdleWatch(query.runId, idle_seconds)
    streams = (spark or SparkSession.getActiveSession()).streams
    streams.addListener(watch)
    try:
        if query.isActive:                    # else it ended before anyone listened
            watch.done.wait(max_seconds)
        if query.isActive:
            query.stop()
        query.awaitTermination()
    finally:
        streams.removeListener(watch)
    return watch.rows


def read_landing(spark: SparkSession, landing_path: str, schema: T.StructType = FARE_RECORD) -> DataFrame:
    """The landed rows; ``fetched_date``, ``run`` and ``epoch_id`` come back as partition columns.

    Partition values are typed here rather than inferred. A landing table written otherwise, without the
    order of arrival, has nulls there.
    """
    fields = list(schema.fields) + [T.StructField("run", T.StringType()), T.StructField("epoch_id", T.LongType()),
                                    T.StructField("file_modification_time", T.TimestampType()),
                                    T.StructField("source_file", T.StringType()), T.StructField("position", T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(landing_path)
