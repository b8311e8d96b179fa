"""Window, partition and predicate filters, and batch assignment."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.planning import MIXED_REQUEST, MIXED_SQL
from acceptance.registry import in_batch_sql, parts_sql, query, table, windows_sql
from batchload import BatchRequest, build, tumbling
from batchload.operators import extract

DAY = 86400


@query(
    "extract_window",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""",
)
def extract_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    year = extract.window(rows, "l_shipdate", datetime(1997, 1, 1), datetime(1998, 1, 1))
    return year.select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")


@query(
    "extract_predicates",
    """SELECT o_orderkey, o_orderstatus, 0 AS predicate_no FROM orders WHERE o_orderstatus = 'F'
       UNION ALL
       SELECT o_orderkey, o_orderstatus, 1 FROM orders WHERE o_orderstatus = 'O'""",
)
def extract_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return extract.by_predicates(rows, ["o_orderstatus = 'F'", "o_orderstatus = 'O'"])


_OVERLAP = [
    "o_orderstatus = 'F'",
    "o_orderpriority = '1-URGENT'",
    "nullif(o_orderstatus, 'P') <> 'O'",
]


@query(
    "extract_predicates_overlap",
    " UNION ALL ".join(
        f"SELECT o_orderkey, o_orderstatus, o_orderpriority, {i} AS predicate_no "
        f"FROM orders WHERE {test}"
        for i, test in enumerate(_OVERLAP)
    ),
)
def extract_predicates_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )
    return extract.by_predicates(rows, _OVERLAP)


@query(
    "extract_partition",
    "SELECT event_id, ts, event_type FROM events WHERE event_type = 'click'",
)
def extract_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return extract.partition(rows, "event_type", "click")


@query(
    "extract_open_end",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:30:00'",
)
def extract_open_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return extract.open_range(rows, "ts", start=datetime(2024, 1, 10, 6, 30))


@query(
    "extract_open_start",
    "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-10 06:30:00'",
)
def extract_open_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return extract.open_range(rows, "ts", end=datetime(2024, 1, 10, 6, 30))


@query(
    "extract_partition_window",
    """SELECT event_id, ts, event_type FROM events WHERE event_type = 'view'
       AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""",
)
def extract_partition_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return extract.partition(
        rows, "event_type", "view", "ts", datetime(2024, 1, 5), datetime(2024, 1, 20)
    )


@query(
    "batch_assign",
    f"""WITH w AS ({windows_sql("1995-01-01", "2002-01-01", 30 * DAY)})
        SELECT l_orderkey, l_linenumber, l_shipdate, batch_id
        FROM lineitem JOIN w ON l_shipdate >= s AND l_shipdate < e""",
)
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = tumbling(spark, "19950101", "20020101", "yyyyMMdd", 30 * DAY)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return extract.assign_batches(rows, plan, "l_shipdate")


@query(
    "batch_assign_mixed",
    f"""WITH w AS ({MIXED_SQL})
        SELECT event_id, ts, event_type, batch_id
        FROM events JOIN w ON {in_batch_sql("ts", "event_type")}""",
)
def batch_assign_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return extract.assign_batches(rows, build(spark, MIXED_REQUEST), "ts", "event_type")


_MANY = [
    ("end", None, None, "2024-01-05"),
    *[("partition", name, None, None) for name in ("click", "view", "click", "signup")],
    *[("partition_range", name, "2024-01-10", "2024-01-15") for name in ("error", "purchase", "error")],
]
_MANY_SQL = parts_sql(_MANY, DAY)


@query(
    "batch_assign_many_items",
    f"""WITH w AS ({_MANY_SQL})
        SELECT events.*, batch_id FROM events JOIN w ON {in_batch_sql("ts", "event_type")}""",
)
def batch_assign_many_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More items than a CASE expression takes, an open range among them, some of them equal."""
    request = BatchRequest(
        name="many",
        pattern="yyyyMMdd",
        end="20240105",
        partitions=(
            "click,view,click,signup,error:20240110-20240115,purchase:20240110-20240115,"
            "error:20240110-20240115"
        ),
        interval_seconds=DAY,
    )
    rows = table(spark, sf_dir, "events")
    return extract.assign_batches(rows, build(spark, request), "ts", "event_type")


# Events moved into the night of a clock change in New York, as instants: at 06:00 UTC local time
# goes from 02:00 back to 01:00.
_NIGHT_SQL = """SELECT event_id, event_type,
           CASE WHEN u < TIMESTAMP '2024-11-03 06:00:00' THEN u - INTERVAL 4 HOUR
                ELSE u - INTERVAL 5 HOUR END AS local_ts
    FROM (SELECT *, TIMESTAMP '2024-11-03 03:00:00' + to_seconds(event_id % 2000 * 11) AS u
          FROM events)"""
_NIGHT_ITEMS = [
    ("partition_range", name, "2024-11-03 01:30:00", "2024-11-03 04:30:00")
    for name in ("click", "view", "signup", "error", "purchase", "click", "view")
]


def _night_oracle(items: list[tuple[str, str | None, str | None, str | None]]) -> str:
    return f"""WITH w AS ({parts_sql(items, 3600)}), n AS ({_NIGHT_SQL})
        SELECT event_id, local_ts, batch_id FROM n JOIN w ON {in_batch_sql("local_ts", "event_type")}"""


def _night(spark: SparkSession, sf_dir: str, names: int) -> DataFrame:
    """Hourly batches from within the hour that comes twice, over a column of instants."""
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "America/New_York")
    try:
        first = F.lit(int(datetime(2024, 11, 3, 3, tzinfo=timezone.utc).timestamp()))
        rows = table(spark, sf_dir, "events").select(
            "event_id",
            "event_type",
            F.timestamp_seconds(first + F.col("event_id") % 2000 * 11).alias("ts"),
        )
        spec = ",".join(f"{item[1]}:202411030130-202411030430" for item in _NIGHT_ITEMS[:names])
        request = BatchRequest("night", "yyyyMMddHHmm", partitions=spec, interval_seconds=3600)
        tagged = extract.assign_batches(rows, build(spark, request), "ts", "event_type")
        local = F.col("ts").cast("timestamp_ntz").alias("local_ts")
        return tagged.select("event_id", local, "batch_id")
    finally:
        spark.conf.set(zone, before)


@query("batch_assign_zoned", _night_oracle(_NIGHT_ITEMS[:1]))
def batch_assign_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a column with a zone go by local time, by expression."""
    return _night(spark, sf_dir, 1)


@query("batch_assign_zoned_many", _night_oracle(_NIGHT_ITEMS))
def batch_assign_zoned_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with more items than an expression takes, by join."""
    return _night(spark, sf_dir, 7)
