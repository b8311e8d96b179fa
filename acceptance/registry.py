"""The registry, table access and the SQL fragments several oracles share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors see.

    The cluster names that folder in `spark.checkpoint.dir`. Only a local session that names none
    gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="batchload-")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def windows_sql(start: str, end: str, seconds: int) -> str:
    """Tumbling windows as a SELECT of batch_id, s and e."""
    return f"""
        SELECT CAST(row_number() OVER (ORDER BY s) - 1 AS BIGINT) AS batch_id, s,
               s + INTERVAL {seconds} SECOND AS e
        FROM (SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}',
                                            INTERVAL {seconds} SECOND)) AS s)
        WHERE s < TIMESTAMP '{end}'"""


def plan_counts_sql(windows: str, table_name: str, time_col: str, strftime: str) -> str:
    """A range plan with the rows of each batch, from a SELECT of batch_id, s and e."""
    return f"""
        WITH w AS ({windows})
        SELECT batch_id, 'range' AS kind, s AS start_ts, e AS end_ts,
               strftime(s, '{strftime}') AS start_text, strftime(e, '{strftime}') AS end_text,
               CAST(NULL AS VARCHAR) AS partition,
               (SELECT count(*) FROM {table_name} WHERE {time_col} >= s AND {time_col} < e)
                   AS n_rows
        FROM w"""


def parts_sql(items: list[tuple[str, str | None, str | None, str | None]], seconds: int) -> str:
    """A plan of several items (kind, partition, start, end) as a SELECT of batch_id, kind, s, e
    and p, in list order."""
    pieces = []
    for number, (kind, partition, start, end) in enumerate(items):
        p = "CAST(NULL AS VARCHAR)" if partition is None else f"'{partition}'"
        if kind == "partition_range":
            pieces.append(
                f"SELECT {number} AS item, '{kind}' AS kind, s, e, {p} AS p "
                f"FROM ({windows_sql(start, end, seconds)})"
            )
        else:
            s = "CAST(NULL AS TIMESTAMP)" if start is None else f"TIMESTAMP '{start}'"
            e = "CAST(NULL AS TIMESTAMP)" if end is None else f"TIMESTAMP '{end}'"
            pieces.append(f"SELECT {number} AS item, '{kind}' AS kind, {s} AS s, {e} AS e, {p} AS p")
    union = " UNION ALL ".join(pieces)
    return f"""
        SELECT CAST(row_number() OVER (ORDER BY item, s) - 1 AS BIGINT) AS batch_id,
               kind, s, e, p
        FROM ({union})"""


def in_batch_sql(time_col: str, partition_col: str) -> str:
    """Whether a row lies in the batch (s, e, p)."""
    return (
        f"(s IS NULL OR {time_col} >= s) AND (e IS NULL OR {time_col} < e) "
        f"AND (p IS NULL OR {partition_col} = p)"
    )


def parts_counts_sql(
    parts: str, table_name: str, time_col: str, partition_col: str, strftime: str = "%Y%m%d"
) -> str:
    """A plan of several items with the rows of each batch."""
    return f"""
        WITH w AS ({parts})
        SELECT batch_id, kind, s AS start_ts, e AS end_ts,
               strftime(s, '{strftime}') AS start_text, strftime(e, '{strftime}') AS end_text,
               p AS partition,
               (SELECT count(*) FROM {table_name} WHERE {in_batch_sql(time_col, partition_col)})
                   AS n_rows
        FROM w"""
