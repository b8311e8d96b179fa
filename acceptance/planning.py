"""Plans, each with the rows its batches hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acceptance.registry import (
    parts_counts_sql,
    parts_sql,
    plan_counts_sql,
    query,
    table,
    windows_sql,
)
from batchload import BatchPlan, BatchRequest, build, partitions, tumbling
from batchload.operators.audit import row_counts_all
from batchload.operators.extract import assign_batches

DAY = 86400


def _orders(spark: SparkSession, sf_dir: str, plan: BatchPlan) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return row_counts_all(assign_batches(rows, plan, "o_orderdate", "o_orderpriority"), plan)


def _events(spark: SparkSession, sf_dir: str, plan: BatchPlan) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return row_counts_all(assign_batches(rows, plan, "ts", "event_type"), plan)


@query(
    "plan_tumbling",
    plan_counts_sql(
        windows_sql("1995-01-01", "2002-01-01", 30 * DAY), "orders", "o_orderdate", "%Y%m%d"
    ),
)
def plan_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(
        spark, sf_dir, tumbling(spark, "19950101", "20020101", "yyyyMMdd", 30 * DAY)
    )


@query(
    "plan_overshoot",
    plan_counts_sql(
        windows_sql("2024-01-01 00:00:05", "2024-01-25 08:36:05", 25000),
        "events",
        "ts",
        "%Y%m%d%H%M%S",
    ),
)
def plan_overshoot(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = tumbling(spark, "20240101000005", "20240125083605", "yyyyMMddHHmmss", 25000)
    return _events(spark, sf_dir, plan)


@query(
    "plan_clamped",
    plan_counts_sql(
        "SELECT batch_id, s, least(e, TIMESTAMP '2024-01-25 08:36:05') AS e FROM ("
        + windows_sql("2024-01-01 00:00:05", "2024-01-25 08:36:05", 25000)
        + ")",
        "events",
        "ts",
        "%Y%m%d%H%M%S",
    ),
)
def plan_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = tumbling(
        spark, "20240101000005", "20240125083605", "yyyyMMddHHmmss", 25000, clamp_end=True
    )
    return _events(spark, sf_dir, plan)


def _cut(windows: str, strftime: str) -> str:
    """Windows with both bounds cut down by a trip through text."""
    return (
        f"SELECT batch_id, strptime(strftime(s, '{strftime}'), '{strftime}') AS s, "
        f"strptime(strftime(e, '{strftime}'), '{strftime}') AS e FROM ({windows})"
    )


@query(
    "plan_text_bounds",
    plan_counts_sql(
        _cut(windows_sql("2024-01-01", "2024-01-31", 36 * 3600), "%Y%m%d"),
        "events",
        "ts",
        "%Y%m%d",
    ),
)
def plan_text_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark, sf_dir, tumbling(spark, "20240101", "20240131", "yyyyMMdd", 36 * 3600)
    )


@query(
    "plan_text_bounds_fine",
    plan_counts_sql(
        _cut(windows_sql("2024-01-01", "2024-01-31", 3600), "%Y%m%d"), "events", "ts", "%Y%m%d"
    ),
)
def plan_text_bounds_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, tumbling(spark, "20240101", "20240131", "yyyyMMdd", 3600))


@query(
    "plan_text_bounds_month",
    plan_counts_sql(
        _cut(windows_sql("1995-01-01", "2002-01-01", 10 * DAY), "%Y%m"),
        "orders",
        "o_orderdate",
        "%Y%m",
    ),
)
def plan_text_bounds_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, tumbling(spark, "199501", "200201", "yyyyMM", 10 * DAY))


_OPEN_SQL = " UNION ALL ".join(
    "SELECT * FROM ("
    + parts_counts_sql(parts_sql([item], DAY), "orders", "o_orderdate", "o_orderpriority")
    + ")"
    for item in [("start", None, "1998-01-01", None), ("end", None, None, "1998-01-01")]
)


@query("plan_open_ended", _OPEN_SQL)
def plan_open_ended(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = build(spark, BatchRequest("from", "yyyyMMdd", start="19980101"))
    end = build(spark, BatchRequest("until", "yyyyMMdd", end="19980101"))
    return _orders(spark, sf_dir, start).unionByName(_orders(spark, sf_dir, end))


_EVENT_TYPES = ["click", "view", "purchase", "signup", "error", "absent"]


@query(
    "plan_partitions",
    parts_counts_sql(
        parts_sql([("partition", name, None, None) for name in _EVENT_TYPES], DAY),
        "events",
        "ts",
        "event_type",
    ),
)
def plan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, partitions(spark, ",".join(_EVENT_TYPES), "yyyyMMdd"))


@query(
    "plan_partition_ranges",
    parts_counts_sql(
        parts_sql(
            [
                ("partition_range", "click", "2024-01-01", "2024-01-15"),
                ("partition_range", "view", "2024-01-10", "2024-01-31"),
                ("partition_range", "click", "2024-01-10", "2024-01-20"),
                ("partition", "error", None, None),
            ],
            DAY,
        ),
        "events",
        "ts",
        "event_type",
    ),
)
def plan_partition_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = "click:20240101-20240115,view:20240110-20240131,click:20240110-20240120,error"
    return _events(spark, sf_dir, partitions(spark, spec, "yyyyMMdd", DAY))


MIXED_REQUEST = BatchRequest(
    name="mixed",
    pattern="yyyyMMdd",
    start="20240120",
    partitions="click,view:20240105-20240125,signup:20240101-20240103",
    interval_seconds=DAY,
)
MIXED_SQL = parts_sql(
    [
        ("start", None, "2024-01-20", None),
        ("partition", "click", None, None),
        ("partition_range", "view", "2024-01-05", "2024-01-25"),
        ("partition_range", "signup", "2024-01-01", "2024-01-03"),
    ],
    DAY,
)


@query("plan_mixed", parts_counts_sql(MIXED_SQL, "events", "ts", "event_type"))
def plan_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, build(spark, MIXED_REQUEST))


@query(
    "plan_precedence",
    plan_counts_sql(windows_sql("2024-01-01", "2024-02-01", DAY), "events", "ts", "%Y%m%d"),
)
def plan_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = BatchRequest(
        name="both",
        pattern="yyyyMMdd",
        start="20240101",
        end="20240201",
        interval_seconds=DAY,
        partitions="click,view",
    )
    return _events(spark, sf_dir, build(spark, request))
