"""Any SELECT may be loaded in batches: parametrised texts with typed bounds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from acceptance.registry import query, table, windows_sql
from batchload import tumbling
from batchload.sources import sql

DAY = 86400
START, MIDDLE, END = datetime(1995, 7, 1), datetime(1998, 7, 1), datetime(2001, 7, 1)
EVENTS_FROM = datetime(2024, 1, 2, 12)


def _oracle(text: str) -> str:
    """The same text for the oracle: views for frames, literals for parameters."""
    for name in ("orders", "customer", "nation", "events"):
        text = text.replace("{" + name + "}", name)
    values = {":start": START, ":middle": MIDDLE, ":end": END, ":from": EVENTS_FROM}
    for name, value in values.items():
        text = text.replace(name, f"TIMESTAMP '{value}'")
    return text


_TEMPLATE = """
    SELECT o_orderkey, o_custkey, o_orderdate, 1 AS sign, o_orderdate AS version
    FROM {orders} WHERE o_orderdate >= :start AND o_orderdate < :end"""

# Orders are counted per customer before the join, so that one customer with very many orders is
# one row in it.
_JOIN = """
    WITH per_customer AS (
        SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first_order,
               max(o_orderdate) AS last_order
        FROM {orders} WHERE o_orderdate >= :start AND o_orderdate < :end GROUP BY o_custkey)
    SELECT n_name, CAST(sum(n) AS BIGINT) AS n_orders, count(*) AS n_customers,
           min(first_order) AS first_order, max(last_order) AS last_order
    FROM per_customer JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"""

# One row per status, priority and customer first: the grouping sets expand those, not raw rows.
_AGGREGATE = """
    WITH per_customer AS (
        SELECT o_orderstatus, o_orderpriority, o_custkey, count(*) AS n,
               min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
               max(o_orderdate) AS last_order
        FROM {orders} WHERE o_orderdate >= :start AND o_orderdate < :end
        GROUP BY o_orderstatus, o_orderpriority, o_custkey)
    SELECT o_orderstatus, o_orderpriority, CAST(sum(n) AS BIGINT) AS n_orders,
           count(DISTINCT o_custkey) AS n_customers, min(lowest) AS lowest,
           max(highest) AS highest, max(last_order) AS last_order
    FROM per_customer
    GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())"""

# The window runs over days already counted, never over raw rows of one priority.
_WINDOW = """
    WITH daily AS (
        SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM {orders}
        WHERE o_orderdate >= :start AND o_orderdate < :end
        GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))
    SELECT o_orderpriority, day, n,
           CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY day) AS BIGINT) AS running,
           lag(n) OVER (PARTITION BY o_orderpriority ORDER BY day) AS previous
    FROM daily"""

_TOPK = """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM {orders}
    WHERE o_orderdate >= :start AND o_orderdate < :end
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""

# Each side is down to one row per customer before it is shuffled. The optimizer drops a DISTINCT
# below a set operation, a GROUP BY with a HAVING stays.
_SETOP = """
    (SELECT o_custkey, 'returning' AS kind FROM {orders}
     WHERE o_orderdate >= :start AND o_orderdate < :middle GROUP BY o_custkey HAVING count(*) > 0
     INTERSECT
     SELECT o_custkey, 'returning' FROM {orders}
     WHERE o_orderdate >= :middle AND o_orderdate < :end GROUP BY o_custkey HAVING count(*) > 0)
    UNION ALL
    (SELECT o_custkey, 'lost' FROM {orders}
     WHERE o_orderdate >= :start AND o_orderdate < :middle GROUP BY o_custkey HAVING count(*) > 0
     EXCEPT
     SELECT o_custkey, 'lost' FROM {orders}
     WHERE o_orderdate >= :middle AND o_orderdate < :end GROUP BY o_custkey HAVING count(*) > 0)"""


def _orders(spark: SparkSession, sf_dir: str, text: str, **more: datetime) -> DataFrame:
    frames = {"orders": table(spark, sf_dir, "orders")}
    return sql.select(spark, text, frames, start=START, end=END, **more)


@query("sql_template", _oracle(_TEMPLATE))
def sql_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _TEMPLATE)


@query("sql_join", _oracle(_JOIN))
def sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation")}
    return sql.select(spark, _JOIN, frames, start=START, end=END)


@query("sql_aggregate", _oracle(_AGGREGATE))
def sql_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _AGGREGATE)


@query("sql_window", _oracle(_WINDOW))
def sql_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _WINDOW)


@query("sql_topk", _oracle(_TOPK))
def sql_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _TOPK)


@query("sql_setop", _oracle(_SETOP))
def sql_setop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, _SETOP, middle=MIDDLE)


@query(
    "sql_json",
    f"""SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               count(*) AS n_events, max(ts) AS last_seen
        FROM events WHERE ts >= TIMESTAMP '{EVENTS_FROM}' GROUP BY 1, 2""",
)
def sql_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT event_type, CAST(get_json_object(props, '$.k') AS BIGINT) AS k,
               count(*) AS n_events, max(ts) AS last_seen
        FROM {events} WHERE ts >= :from GROUP BY 1, 2"""
    frames = {"events": table(spark, sf_dir, "events")}
    return sql.select(spark, text, frames, **{"from": EVENTS_FROM})


_FILLED = """
    SELECT get_json_object(props, '$.k') AS k, '$start' AS literal, count(*) AS n_events
    FROM {events} WHERE event_type = '${partition}' AND ts >= TIMESTAMP_NTZ'${start}'
    GROUP BY get_json_object(props, '$.k')"""


@query(
    "sql_fill",
    """SELECT json_extract_string(props, '$.k') AS k, '$start' AS literal, count(*) AS n_events
       FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-02' GROUP BY 1, 2""",
)
def sql_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filled text with a JSON path and a literal that look like placeholders."""
    text = sql.fill(_FILLED, start="2024-01-02 00:00:00", partition="click")
    return sql.select(spark, text, {"events": table(spark, sf_dir, "events")})


@query(
    "sql_per_batch",
    f"""WITH w AS ({windows_sql("1995-01-01", "2002-01-01", 365 * DAY)})
        SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers, batch_id
        FROM orders JOIN w ON o_orderdate >= s AND o_orderdate < e GROUP BY batch_id, 1""",
)
def sql_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers
        FROM {orders} WHERE o_orderdate >= :start AND o_orderdate < :end GROUP BY o_orderstatus"""
    frames = {"orders": table(spark, sf_dir, "orders")}
    plan = tumbling(spark, "19950101", "20020101", "yyyyMMdd", 365 * DAY)
    return sql.select_each(spark, text, plan, frames)


@query(
    "sql_batches",
    f"""WITH w AS ({windows_sql("1995-01-01", "2002-01-01", DAY)})
        SELECT batch_id, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS highest
        FROM orders JOIN w ON o_orderdate >= s AND o_orderdate < e
        WHERE o_orderstatus <> 'P' GROUP BY ALL""",
)
def sql_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate of each of 2,557 batches, in one scan."""
    plan = tumbling(spark, "19950101", "20020101", "yyyyMMdd", DAY)
    text = """SELECT batch_id, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS highest
              FROM {rows} WHERE o_orderstatus <> :skipped GROUP BY batch_id, o_orderpriority"""
    rows = table(spark, sf_dir, "orders")
    return sql.select_batches(spark, text, rows, plan, "o_orderdate", skipped="P")
