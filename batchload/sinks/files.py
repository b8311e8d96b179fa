"""Append to catalog tables and write batches as partitioned files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchload.operators.audit import BATCH_KEY, current, row_counts
from batchload.plans.batch_plan import BatchPlan


def insert_into(df: DataFrame, table: str) -> None:
    """Append to a catalog table by column position, whatever the columns are called."""
    df.write.insertInto(table)


def write_batches(
    tagged: DataFrame, attempt: str, path: str, load_name: str, rebalance: bool = True
) -> None:
    """Write tagged rows as Parquet under `load_name=.../attempt=.../batch_id=...`.

    Every attempt is a write of its own folder, so several may run at the same time.

    Every attempt has folders of its own, and the manifest says which attempt of a batch counts:
    `read_batches` reads those. So a rerun replaces a batch as a whole, also by nothing, whatever
    its number was in an earlier plan, and an attempt that failed is never read.

    The rebalance hint shuffles the rows of a batch together and splits a batch that is larger than
    the others over several tasks (adaptive execution must be on, as it is by default). Without it
    every task writes one file per batch it meets: cheaper where the source is already in time
    order, very many small files where it is not.
    """
    if rebalance:
        tagged = tagged.hint("rebalance", "batch_id")
    folder = f"{path.rstrip('/')}/load_name={_folder_name(load_name)}/attempt={attempt}"
    tagged.write.mode("append").partitionBy("batch_id").parquet(folder)


def _folder_name(value: str) -> str:
    """A partition value as Spark spells it in a path: signs of ASCII but a few as %XX."""
    return re.sub(r"[^\w.@+, -]", _escaped, value)


def _escaped(match: re.Match) -> str:
    return f"%{ord(match[0]):02X}" if match[0].isascii() else match[0]


def read_batches(
    spark: SparkSession,
    path: str,
    finished: DataFrame,
    load_name: str,
    schema: str,
    with_key: bool = False,
) -> DataFrame:
    """The rows of a load as the manifest `finished` has them, tagged with `batch_id`, the number
    of their batch in the plan that loaded it last.

    Numbers of different plans may be equal: with `with_key` bounds, partition and occurrence, which
    tell batches apart, come too.

    `schema` is that of the rows, without `batch_id`. Folders are picked by the manifest: it has one
    row per batch, and only folders that it names are read.
    """
    kept = current(finished).where(F.col("load_name") == load_name)
    kept = kept.select("attempt", "batch_id", *(BATCH_KEY if with_key else ()))
    partitions = "load_name string, attempt string, batch_id bigint"
    files = spark.read.schema(f"{schema}, {partitions}").parquet(path)
    files = files.where(F.col("load_name") == load_name)
    return files.join(kept, ["attempt", "batch_id"]).drop("attempt", "load_name")


def written_counts(
    spark: SparkSession, path: str, load_name: str, plan: BatchPlan, attempt: str
) -> DataFrame:
    """Rows per batch of a plan as an attempt has written them; no data column is read."""
    if not plan.items:
        return spark.createDataFrame([], "batch_id bigint, n_rows bigint")
    first, last = plan.items[0].first_batch_id, plan.items[-1].last_batch_id
    schema = "load_name string, attempt string, batch_id bigint"
    files = spark.read.schema(schema).parquet(path)
    return row_counts(
        files.where(
            (F.col("load_name") == load_name)
            & (F.col("attempt") == attempt)
            & F.col("batch_id").between(first, last)
        )
    )
