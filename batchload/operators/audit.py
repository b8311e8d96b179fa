"""Counts per batch, the manifest of finished batches, resume and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchload.operators.extract import plan_side
from batchload.plans.batch_plan import BatchPlan

# What a batch is, whatever plan it is numbered in: its bounds, its partition, and which one it is
# among batches of a plan that are equal in these.
BATCH_KEY = ("start_ts", "end_ts", "partition", "occurrence")
MANIFEST_SCHEMA = (
    "load_name string, batch_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, "
    "partition string, occurrence int, attempt string, n_rows bigint, status string, "
    "finished_at timestamp"
)
# Written before a job writes its rows, so that a job whose driver was killed leaves a trace.
STARTED_SCHEMA = (
    "load_name string, batch_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, "
    "partition string, occurrence int, started_at timestamp, attempt string"
)
# One row for every job of a load, with what was seen to pass by while it wrote.
JOBS_SCHEMA = (
    "load_name string, attempt string, first_batch_id bigint, last_batch_id bigint, "
    "status string, n_rows bigint, least_ts timestamp_ntz, greatest_ts timestamp_ntz, "
    "seconds double, finished_at timestamp"
)
# Batches in these states are in the target. `uncounted` ones are, but nobody knows how many rows.
LOADED = ("ok", "uncounted")


def numbered(plan_frame: DataFrame) -> DataFrame:
    """Plan rows with `occurrence`: 1 for the first batch of its bounds and partition, then 2 ..."""
    if "occurrence" in plan_frame.columns:
        return plan_frame
    equal = Window.partitionBy("start_ts", "end_ts", "partition").orderBy("batch_id")
    return plan_frame.withColumn("occurrence", F.row_number().over(equal))


def row_counts(tagged: DataFrame) -> DataFrame:
    """Rows per batch; batches without rows are absent. Counted map-side before the shuffle."""
    return tagged.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


def with_counts(batches: DataFrame, counts: DataFrame, n_batches: int) -> DataFrame:
    """Batches with their `n_rows`, zero for those without rows."""
    return batches.join(plan_side(counts, n_batches), "batch_id", "left").withColumn(
        "n_rows", F.coalesce(F.col("n_rows"), F.lit(0).cast("bigint"))
    )


def row_counts_all(tagged: DataFrame, plan: BatchPlan) -> DataFrame:
    """The whole plan with the row count of every batch, zero for empty ones."""
    return with_counts(plan.frame(tagged.sparkSession), row_counts(tagged), plan.n_batches)


def summary(counted: DataFrame) -> DataFrame:
    """One row: batches, batches with rows, and rows, of a `row_counts_all` result."""
    return counted.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.count_if(F.col("n_rows") > 0).alias("n_nonempty"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
    )


def manifest(
    batches: DataFrame, status: str, load_name: str = "load", attempt: str | None = None
) -> DataFrame:
    """Manifest rows for plan rows (with or without `n_rows`) that ended in `status`.

    Number the rows of a part of a plan beforehand, with `numbered` on the whole plan.
    """
    n_rows = F.col("n_rows") if "n_rows" in batches.columns else F.lit(None)
    return numbered(batches).select(
        F.lit(load_name).alias("load_name"),
        "batch_id",
        *BATCH_KEY,
        F.lit(attempt).cast("string").alias("attempt"),
        n_rows.cast("bigint").alias("n_rows"),
        F.lit(status).alias("status"),
        F.current_timestamp().alias("finished_at"),
    )


def _same_batch(left: DataFrame, right: DataFrame) -> Column:
    """Batches are the same if their bounds and partition are; any of them may be NULL."""
    condition = F.lit(True)
    for name in BATCH_KEY:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def pending(plan_frame: DataFrame, finished: DataFrame, load_name: str = "load") -> DataFrame:
    """Plan rows, with `occurrence`, that the manifest does not know as loaded by this load."""
    plan_frame = numbered(plan_frame)
    mine = finished.where((F.col("load_name") == load_name) & F.col("status").isin(*LOADED))
    done = mine.select(*BATCH_KEY).distinct()
    return plan_frame.join(done, _same_batch(plan_frame, done), "left_anti")


def started(batches: DataFrame, load_name: str = "load") -> DataFrame:
    """What is written down of batches before their rows are; number them as for `manifest`."""
    return numbered(batches).select(
        F.lit(load_name).alias("load_name"),
        "batch_id",
        *BATCH_KEY,
        F.current_timestamp().alias("started_at"),
    )


def failed_before(
    batches: DataFrame,
    finished: DataFrame,
    load_name: str = "load",
    begun: DataFrame | None = None,
) -> DataFrame:
    """Those plan rows of which an earlier run of this load failed, or began (according to `begun`)
    and never ended."""
    mine = F.col("load_name") == load_name
    failed = finished.where(mine & (F.col("status") == "failed")).select(*BATCH_KEY)
    if begun is not None:
        ended = finished.select("attempt").distinct()
        left = begun.where(mine).join(ended, "attempt", "left_anti")
        failed = failed.unionAll(left.select(*BATCH_KEY))
    failed = failed.distinct()
    return batches.join(failed, _same_batch(batches, failed), "left_semi")


def current(finished: DataFrame) -> DataFrame:
    """For each batch of each load, the row of its last run that is in the target."""
    loaded = finished.where(F.col("status").isin(*LOADED))
    last = F.max_by(F.struct("attempt", "batch_id", "n_rows"), "finished_at").alias("last")
    return loaded.groupBy("load_name", *BATCH_KEY).agg(last).select(
        "load_name", *BATCH_KEY, "last.*"
    )


def reconcile(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Compare rows per batch of source and target.

    `status` is `ok`, `differs`, `missing_in_target` or `missing_in_source`.
    """
    s, t = F.col("source_rows"), F.col("target_rows")
    source = source_counts.select("batch_id", F.col("n_rows").alias("source_rows"))
    target = target_counts.select("batch_id", F.col("n_rows").alias("target_rows"))
    return source.join(target, "batch_id", "full_outer").withColumn(
        "status",
        F.when(t.isNull(), "missing_in_target")
        .when(s.isNull(), "missing_in_source")
        .when(s == t, "ok")
        .otherwise("differs"),
    )


def by_slice(counted: DataFrame, plan: BatchPlan, num_slices: int) -> DataFrame:
    """Batches and rows of each of the slices that `plan.split` makes of a whole plan."""
    n = min(num_slices, plan.n_batches)
    slice_no = F.call_function("div", F.col("batch_id") * n, F.lit(plan.n_batches))
    return counted.groupBy(slice_no.alias("slice_no")).agg(
        F.min("batch_id").alias("first_batch_id"),
        F.max("batch_id").alias("last_batch_id"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("n_rows").alias("n_rows"),
    )
