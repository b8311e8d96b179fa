"""Filters and batch assignment.

Every operator reads its input once. Bounds are typed literals of the time column's own type, so
they reach the scan as pushed filters.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, time, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchload.functions.patterns import CALENDAR_MONTHS, UNIT_SECONDS, ntz_literal
from batchload.operators.project import quoted
from batchload.plans.batch_plan import WINDOWED, BatchPlan, PlanItem

# Sides of a join derived from a plan are broadcast up to this many rows, a number known exactly
# beforehand; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000

# Plans of up to this many items are matched by a CASE expression, longer ones by a join. The
# expression is about twice as fast for a few items, but its generated code soon grows too large.
INLINE_ITEMS = 6

DAY = timedelta(days=1)

# Partition names pushed to the scan as an IN list.
PUSHED_NAMES = 1_000


def plan_side(side: DataFrame, n_rows: int) -> DataFrame:
    """Join hint for a side with at most `n_rows` rows."""
    return F.broadcast(side) if n_rows <= BROADCAST_ROWS else side.hint("merge")


def _bound(df: DataFrame, time_col: str, value: datetime) -> Column:
    kind = df.schema[time_col].dataType
    if isinstance(kind, T.TimestampNTZType):
        return ntz_literal(value)
    if isinstance(kind, T.TimestampType):
        return F.expr(f"TIMESTAMP_LTZ'{value.isoformat(sep=' ')}'")
    if isinstance(kind, T.DateType):
        day = value.date() if value.time() == time.min else value.date() + timedelta(days=1)
        return F.expr(f"DATE'{day.isoformat()}'")
    raise ValueError(f"{time_col} is {kind.simpleString()}; cast it to a timestamp or date first")


def in_bounds(
    df: DataFrame, time_col: str | None, lower: datetime | None, upper: datetime | None
) -> Column:
    """`lower <= time < upper`; a missing bound is open. Rows without a time match no bound."""
    conditions = []
    if lower is not None:
        conditions.append(F.col(time_col) >= _bound(df, time_col, lower))
    if upper is not None:
        conditions.append(F.col(time_col) < _bound(df, time_col, upper))
    if conditions and isinstance(df.schema[time_col].dataType, T.TimestampType):
        # Bounds are zone-free: local times are compared, also where a clock change repeats an
        # hour. They are compared by their difference, as the optimizer would turn a comparison with
        # the cast column into one of instants. The scan gets bounds that are a day wider.
        conditions = []
        local, zero = F.col(time_col).cast("timestamp_ntz"), F.expr("INTERVAL '0' SECOND")
        if lower is not None:
            conditions.append(F.col(time_col) >= _bound(df, time_col, lower - DAY))
            conditions.append(local - ntz_literal(lower) >= zero)
        if upper is not None:
            conditions.append(F.col(time_col) < _bound(df, time_col, upper + DAY))
            conditions.append(local - ntz_literal(upper) < zero)
    return reduce(Column.__and__, conditions) if conditions else F.lit(True)


def window(df: DataFrame, time_col: str, start: datetime, end: datetime) -> DataFrame:
    """Rows of the half-open window [start, end)."""
    return df.where(in_bounds(df, time_col, start, end))


def open_range(
    df: DataFrame, time_col: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rows at or after `start`, or before `end`; exactly one is given."""
    if (start is None) == (end is None):
        raise ValueError("give exactly one of start and end")
    return df.where(in_bounds(df, time_col, start, end))


def within_days(
    df: DataFrame, day_col: str, start: datetime | None, end: datetime | None
) -> DataFrame:
    """Rows whose day can lie in [start, end), by a DATE column that holds the day of their time.

    Put before `window` or `assign_batches` on a table partitioned by day (with `*plan.hull()` as
    the bounds), it prunes partitions; the time filter alone has to look into every file.
    """
    if start is not None:
        df = df.where(F.col(day_col) >= F.lit(start.date()))
    if end is not None:
        df = df.where(F.col(day_col) <= F.lit((end - timedelta(microseconds=1)).date()))
    return df


def partition(
    df: DataFrame,
    partition_col: str,
    name: str,
    time_col: str | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Rows of one named partition, optionally within a window."""
    return df.where((F.col(partition_col) == name) & in_bounds(df, time_col, start, end))


def by_predicates(df: DataFrame, predicates: list[str]) -> DataFrame:
    """UNION ALL of one filter per SQL predicate, in a single scan.

    A row comes once for each predicate it meets and not at all if it meets none. `predicate_no`
    says which predicate a row came from.
    """
    if not predicates:
        raise ValueError("give at least one predicate")
    tests = [F.expr(p) for p in predicates]
    any_of = tests[0]
    for test in tests[1:]:
        any_of = any_of | test
    hits = F.array(*[F.when(test, F.lit(i)) for i, test in enumerate(tests)])
    hit_rows = df.where(any_of).withColumn("predicate_no", F.explode(hits))
    return hit_rows.where(F.col("predicate_no").isNotNull())


def _steps(ts: Column, origin: Column, seconds: int, plan: BatchPlan) -> Column:
    """Whole steps of `seconds` from `origin` to `ts`.

    `unix_timestamp` of a TIMESTAMP_NTZ is one division, several times faster than subtracting
    timestamps, but drops fractions of a second towards 1970: not for plans from before then.
    """
    if all(
        item.origin >= datetime(1970, 1, 1) and item.origin.microsecond == 0
        for item in plan.items
        if item.kind in WINDOWED
    ):
        elapsed = F.unix_timestamp(ts) - F.unix_timestamp(origin)
        return F.call_function("div", elapsed, F.lit(seconds).cast("bigint"))
    return F.call_function("div", ts - origin, F.expr(f"INTERVAL '{seconds}' SECOND"))


def _window_number(ts: Column, origin: Column, plan: BatchPlan) -> Column:
    """Number of the window a time at or after `origin` falls into.

    Window bounds are cut down to the pattern's unit, so a row belongs to the window that holds
    the last instant of the row's unit.
    """
    seconds = plan.interval_seconds
    if not plan.cuts_bounds:
        return _steps(ts, origin, seconds, plan)
    if plan.unit in CALENDAR_MONTHS:
        unit_end = F.add_months(F.trunc(ts.cast("date"), plan.unit), CALENDAR_MONTHS[plan.unit])
        elapsed = F.date_diff(unit_end, origin.cast("date")).cast("bigint") * 86400 - 1
    else:
        unit = UNIT_SECONDS[plan.unit]
        elapsed = (_steps(ts, origin, unit, plan) + 1) * unit - 1
    return F.call_function("div", elapsed, F.lit(seconds))


def assign_batches(
    df: DataFrame,
    plan: BatchPlan,
    time_col: str | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Rows of `df` that belong to the plan, tagged with `batch_id`.

    A row comes once for each item of the plan it belongs to, as if every batch had been selected
    on its own, but the input is read once and, for plans of a few items, without any join. Many
    items are equi-joined on the partition name, with one row per item (not per batch) on the
    small side.
    """
    if "batch_id" in df.columns:
        raise ValueError("the rows have a batch_id already; rename it first")
    kinds = {item.kind for item in plan.items}
    if kinds - {"partition"} and time_col is None:
        raise ValueError("the plan has time bounds: time_col is required")
    if any(item.partition is not None for item in plan.items) and partition_col is None:
        raise ValueError("the plan names partitions: partition_col is required")
    if not plan.items:
        return df.where(F.lit(False)).withColumn("batch_id", F.lit(None).cast("bigint"))
    if len(plan.items) <= INLINE_ITEMS:
        return _assign_inline(df, plan, time_col, partition_col)
    return _assign_joined(df, plan, time_col, partition_col)


def partition_keys(df: DataFrame, plan: BatchPlan, partition_col: str | None) -> dict[str, object]:
    """What the partition names of a plan are as values of the column: `01` and `1` may be one."""
    names = sorted({item.partition for item in plan.items if item.partition is not None})
    if not names:
        return {}
    kind = df.schema[partition_col].dataType
    values = df.sparkSession.range(1).select(
        F.array(*[F.lit(name).try_cast(kind) for name in names])
    )
    return dict(zip(names, values.first()[0]))


def _assign_inline(
    df: DataFrame, plan: BatchPlan, time_col: str | None, partition_col: str | None
) -> DataFrame:
    """One CASE expression for each set of items that exclude each other."""
    any_of, hits = None, []
    for layer in plan.layers(partition_keys(df, plan, partition_col)):
        hit = None
        for item in layer.items:
            test = in_bounds(df, time_col, plan.lower(item), plan.upper(item))
            if item.partition is not None:
                kind = df.schema[partition_col].dataType
                test = (F.col(partition_col) == F.lit(item.partition).cast(kind)) & test
            batch_id = F.lit(item.first_batch_id).cast("bigint")
            if item.kind in WINDOWED:
                ts = F.col(time_col).cast("timestamp_ntz")
                number = _window_number(ts, ntz_literal(item.origin), plan)
                batch_id = number + F.lit(item.first_batch_id - item.first_window).cast("bigint")
            any_of = test if any_of is None else any_of | test
            hit = F.when(test, batch_id) if hit is None else hit.when(test, batch_id)
        hits.append(hit)
    rows = df.where(any_of)
    if len(plan.items) == 1:
        return rows.withColumn("batch_id", batch_id)
    if len(hits) == 1:
        return rows.withColumn("batch_id", hits[0])
    exploded = rows.withColumn("batch_id", F.explode(F.array(*hits)))
    return exploded.where(F.col("batch_id").isNotNull())


def _assign_joined(
    df: DataFrame, plan: BatchPlan, time_col: str | None, partition_col: str
) -> DataFrame:
    whole = [item for item in plan.items if item.partition is None]
    named = [item for item in plan.items if item.partition is not None]
    if whole and len(plan.items) > BROADCAST_ROWS:
        # In a shuffle, all rows of the open range would meet at the one item without a partition.
        parts = [replace(plan, items=tuple(part)) for part in (whole, named)]
        return _assign_inline(df, parts[0], time_col, partition_col).unionAll(
            _assign_joined(df, parts[1], time_col, partition_col)
        )
    rows = df.where(_plan_filter(df, plan, whole, named, time_col, partition_col))

    # A row competes for the items of its partition and, if there is one, for the open range,
    # which has no partition name.
    kind = df.schema[partition_col].dataType
    key = F.col(partition_col)
    if whole:
        none = F.lit(None).cast(kind)
        keys = F.when(key.isNull(), F.array(none)).otherwise(F.array(none, key))
        rows = rows.withColumn("__bl_key", F.explode(keys))
    else:
        rows = rows.withColumn("__bl_key", key)

    items = plan.items_frame(df.sparkSession).select(
        F.col("partition").cast(kind).alias("__bl_partition"),
        F.when(F.col("kind").isin(*WINDOWED), F.col("origin")).alias("__bl_origin"),
        F.col("lower").alias("__bl_lower"),
        F.col("upper").alias("__bl_upper"),
        (F.col("first_batch_id") - F.col("first_window")).alias("__bl_shift"),
    )
    if whole:
        on = F.col("__bl_key").eqNullSafe(F.col("__bl_partition"))
    else:
        on = F.col("__bl_key") == F.col("__bl_partition")
    batch_id = F.col("__bl_shift")
    if time_col is not None:
        ts = F.col(time_col).cast("timestamp_ntz")
        on = (
            on
            & (F.col("__bl_lower").isNull() | (ts >= F.col("__bl_lower")))
            & (F.col("__bl_upper").isNull() | (ts < F.col("__bl_upper")))
        )
        if plan.interval_seconds:
            number = _window_number(ts, F.col("__bl_origin"), plan)
            batch_id = batch_id + F.coalesce(number, F.lit(0))
    joined = rows.join(plan_side(items, len(plan.items)), on)
    return joined.select(*map(quoted, df.columns), batch_id.alias("batch_id"))


def _plan_filter(
    df: DataFrame,
    plan: BatchPlan,
    whole: list[PlanItem],
    named: list[PlanItem],
    time_col: str | None,
    partition_col: str,
) -> Column:
    """A condition on plain columns that covers the plan, for the scan to prune by."""
    condition = in_bounds(df, time_col, *replace(plan, items=tuple(named)).hull())
    names = sorted({item.partition for item in named})
    if len(names) <= PUSHED_NAMES:
        kind = df.schema[partition_col].dataType
        condition = condition & F.col(partition_col).isin(*[F.lit(n).cast(kind) for n in names])
    else:
        condition = condition & F.col(partition_col).isNotNull()
    for item in whole:
        condition = condition | in_bounds(df, time_col, plan.lower(item), plan.upper(item))
    return condition
