"""Table changes as DataFrame functions: latest-wins dedup, upserts, deletes, retention, purge.

Parquet tables support neither MERGE nor DELETE, so each change maps (current table, change) to the new
table. The writers in :mod:`faresight.sources.sinks` persist a result by dynamic partition overwrite
(only the partitions a change touches are rewritten) or as a new snapshot.

Null handling follows SQL: key columns match with ``=`` (a null key never matches, so an upsert inserts
null-key rows again on every run), and a delete keeps rows whose predicate is null.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from faresight.constants import AGG_KEY, FARE_COLUMNS, FARE_KEY, RETENTION_DAYS
from faresight.functions.keys import null_safe_true
from faresight.functions.time import in_day_window

LEAST = -(1 << 63)                            # stands for a null batch id: below any


def _complete(key: list[str]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(k).isNotNull()
    return cond


def latest_per_key(df: DataFrame, key: list[str], order: list[str],
                   null_keys_distinct: bool = True) -> DataFrame:
    """One row per ``key``: the row that is greatest by ``order``, then by the remaining columns.

    An aggregate with a partial (map-side) step, so a hot key is reduced on every map task before the
    shuffle instead of being sorted whole in one task as a ``row_number`` window would. Nulls are the least.
    With two ordering columns and no others it is a maximum by key and first column, then the maximum by that
    column: primitive buffers, hence hash aggregates. Otherwise it is ``max(struct(order..., rest...))``;
    the trailing columns make ties deterministic.

    With ``null_keys_distinct`` (SQL unique-key semantics) a row with a null key part conflicts with
    nothing: such rows are kept as they are, beside the aggregate.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    keyed = df.where(_complete(key)) if null_keys_distinct else df
    if len(order) == 2 and not rest and dict(df.dtypes)[order[0]] == "bigint":
        first, second = order
        best = keyed.withColumn(first, F.coalesce(first, F.lit(LEAST))).groupBy(*key, first).agg(F.max(second).alias(second)) \
            .groupBy(*key).agg(F.max(first).alias(first), F.max_by(second, first).alias(second)) \
            .withColumn(first, F.when(F.col(first) != LEAST, F.col(first)))
    else:
        packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
        best = keyed.groupBy(*key).agg(packed).select(*key, *[F.col(f"_w.{c}").alias(c) for c in order + rest])
    columns = [*key, *order, *rest]
    if not null_keys_distinct:
        return best.select(*columns)
    return best.select(*columns).unionByName(df.where(~_complete(key)).select(*columns))


def batch_bounds(landing: DataFrame, day: str | dt.date) -> DataFrame:
    """``min(batch_id), max(batch_id)`` of the landing rows fetched on ``day``; nulls when none."""
    return (landing.where(F.col("fetched_date") == F.lit(day).cast("date"))
            .agg(F.min("batch_id").alias("min_batch_id"), F.max("batch_id").alias("max_batch_id")))


def upsert(current: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """INSERT … ON CONFLICT (key) DO UPDATE: changed rows replace current rows with an equal key.

    ``changes`` must be key-unique (see :func:`latest_per_key`). Equality is SQL ``=``: null keys never
    conflict, so those change rows are added as new rows.

    Written as one full outer join on the key, so the change set is read once (an anti join plus a
    union would evaluate it twice); when both sides are already partitioned by the key — as
    aggregates on that key are — the join adds no shuffle.
    """
    cols = current.columns
    rest = [c for c in cols if c not in key]
    new = changes.select(*key, *[F.col(c).alias(f"_new_{c}") for c in rest],
                         F.lit(True).alias("_is_new"))
    j = current.join(new, on=key, how="full_outer")
    return j.select(*[F.col(c) if c in key else
                      F.when(F.col("_is_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                      for c in cols])


def upsert_partitions(current: DataFrame, changes: DataFrame, key: list[str], partition_col: str,
                      values: list) -> DataFrame:
    """The rows of the ``partition_col`` partitions listed in ``values`` after :func:`upsert`.

    ``partition_col`` must be part of ``key``, so rows outside the listed partitions cannot conflict and
    are left untouched (a null is a partition like any other); writing this result with dynamic partition overwrite rewrites only those
    partitions (the filter on ``current`` prunes the scan to them).
    """
    if partition_col not in key:
        raise ValueError("partition column must be part of the key")
    touched = F.coalesce(F.col(partition_col).isin([v for v in values if v is not None]), F.lit(None in values))
    return upsert(current.where(touched), changes.where(touched), key)


ARRIVAL_FILE = ("run", "epoch_id", "file_modification_time", "source_file")
POSITIONS = 10 ** 19                          # more than any position (a long)


def _arrival(landing: DataFrame) -> DataFrame:
    """``landing`` with ``arrived``: one number for the order of arrival, a decimal of 38 digits.

    Its high digits are the place of the row's file among all files (by run, epoch, time and path: one row for each
    file is sorted, and handed to every task: a shuffle by file would give all rows of a file to one), its low digits the row's position. Rows of a table that was landed without positions have their
    fare there, which decides between rows that nothing else tells apart.
    """
    file = F.struct(*[F.col(c) for c in ARRIVAL_FILE if c in landing.columns])
    rows = landing.withColumn("_file", file)
    files = rows.select("_file").distinct().withColumn("_rank", F.row_number().over(Window.orderBy("_file")))
    position = F.coalesce(F.col("position").cast("decimal(19,0)"), F.col("adult_fare").cast("decimal(19,0)") + F.lit(1 << 31), F.lit(0).cast("decimal(19,0)"))
    arrived = (F.col("_rank").cast("decimal(18,0)") * F.lit(str(POSITIONS)).cast("decimal(20,0)") + position).cast("decimal(38,0)")
    return rows.join(F.broadcast(files), "_file").withColumn("arrived", arrived)


def fare_latest(landing: DataFrame) -> DataFrame:
    """Landing rows reduced to the last-written row per fare key: highest batch id, then last to arrive, then fare.

    Rows that the stream landed carry the order of their arrival, which decides where the files have no batch id. It is
    ranked into one number first, so that the aggregates keep buffers of fixed size and stay hash aggregates:
    the last to arrive by key and batch, then the highest batch by key.
    """
    if "position" not in landing.columns:
        return latest_per_key(landing.select("batch_id", *FARE_COLUMNS), list(FARE_KEY), ["batch_id", "adult_fare"]).select(*FARE_COLUMNS)
    keyed = landing.where(_complete(list(FARE_KEY)))
    best = _arrival(keyed).withColumn("batch_id", F.coalesce("batch_id", F.lit(LEAST))) \
        .groupBy(*FARE_KEY, "batch_id").agg(F.max_by("adult_fare", "arrived").alias("adult_fare")) \
        .groupBy(*FARE_KEY).agg(F.max_by("adult_fare", "batch_id").alias("adult_fare"))
    return best.select(*FARE_COLUMNS).unionByName(landing.where(~_complete(list(FARE_KEY))).select(*FARE_COLUMNS))


def landing_range(landing: DataFrame, day, min_batch_id=None, max_batch_id=None) -> DataFrame:
    """The landing rows that a run date migrates: its batch-id range, and its own rows without a batch id."""
    own = F.col("batch_id").isNull() & (F.col("fetched_date") == F.lit(day).cast("date"))
    inside = F.col("batch_id").between(F.lit(min_batch_id).cast("bigint"), F.lit(max_batch_id).cast("bigint"))
    return landing.where(F.coalesce(inside, F.lit(False)) | F.coalesce(own, F.lit(False)))


def migrate_landing(fares: DataFrame, landing: DataFrame, min_batch_id=None, max_batch_id=None) -> DataFrame:
    """Fact table after moving landing rows with ``min_batch_id <= batch_id <= max_batch_id`` into it.

    One set-based pass replaces chunked commits: per key the highest batch id wins, which is what
    applying the chunks in id order leaves behind. Rows in the id range move whatever their date.
    Without bounds every landing row moves.
    """
    rows = landing
    if min_batch_id is not None or max_batch_id is not None:
        if min_batch_id is None or max_batch_id is None:
            return fares  # empty day: bounds are (null, null), nothing to migrate
        rows = landing.where(F.col("batch_id").between(F.lit(min_batch_id), F.lit(max_batch_id)))
    return upsert(fares.select(*FARE_COLUMNS), fare_latest(rows), list(FARE_KEY))


def migrate_day(fares: DataFrame, landing: DataFrame, day) -> DataFrame:
    """Migration of one run date: id bounds of ``day``, then :func:`migrate_landing` over that range.

    The bounds are one global min/max aggregate (a single small row) read back as job parameters.
    """
    row = batch_bounds(landing, day).first()
    return migrate_landing(fares, landing_range(landing, day, row["min_batch_id"], row["max_batch_id"]))


def keep_where_not(df: DataFrame, delete_pred: Column, observation: Observation | None = None) -> DataFrame:
    """Rows a SQL ``DELETE … WHERE delete_pred`` leaves behind (null predicate = row stays).

    With an ``Observation`` the first action records how many rows were ``scanned``, ``removed``, and kept because the
    predicate is ``undecided``.
    """
    hit = null_safe_true(delete_pred)
    if observation is not None:
        df = df.observe(observation, F.count(F.when(hit, 1)).alias("removed"), F.count(F.lit(1)).alias("scanned"),
                        F.count(F.when(delete_pred.isNull(), 1)).alias("undecided"))
    return df.where(~hit)


def delete_departed(flights: DataFrame, day, zone: str = "Asia/Seoul",
                    observation: Observation | None = None) -> DataFrame:
    """Flights left after deleting those departing within the local day ``day`` (all routes)."""
    return keep_where_not(flights, in_day_window("depart_timestamp", day, zone), observation)


def retain_recent(agg: DataFrame, day, days: int = RETENTION_DAYS,
                  observation: Observation | None = None) -> DataFrame:
    """Aggregate rows left after deleting ``fetched_date <= day - days``."""
    cutoff = F.date_sub(F.lit(day).cast("date"), days)
    return keep_where_not(agg, F.col("fetched_date") <= cutoff, observation)


def purge_landing(landing: DataFrame, day, observation: Observation | None = None) -> DataFrame:
    """Landing rows left after deleting those fetched on ``day``."""
    return keep_where_not(landing, F.col("fetched_date") == F.lit(day).cast("date"), observation)


def agg_upsert(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Aggregate table after upserting a fresh daily aggregate on the nine-column key."""
    return upsert(current, fresh, list(AGG_KEY))
