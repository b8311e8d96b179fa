"""What several operators share: the shared folder, checkpoints, hashing, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below `spark.checkpoint.dir`, the folder that all executors see.

    Only a local session that names none gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return os.path.join(root, f"llm-{uuid.uuid4().hex}")


_LOCAL: list[str] = []


def _local_root() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="llm-"))
    return _LOCAL[0]


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, with no lineage behind it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Documents that Python gets at once, in queries over whole texts.
BATCH_DOCUMENTS = 1_000


def document_batches(spark: SparkSession) -> None:
    """Sets the session to send documents to Python in batches of BATCH_DOCUMENTS or fewer.

    The default of ten thousand rows is meant for rows of a few numbers; batches of whole texts take
    that much more memory in every Python worker.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_DOCUMENTS:
        spark.conf.set(name, str(BATCH_DOCUMENTS))


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """What is computed inside sends batches of so many rows to Python, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def mix64(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: near-equal inputs give unrelated outputs."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge list; component is the smallest node reachable.

    Rounds of hooking and pointer jumping: every node takes the smallest label among its own and its
    neighbours', then the label of that label, so that long chains take a logarithmic number of
    rounds. Labels are one row per node, written to the shared folder each round.
    """
    edges = stored(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    )
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("component")
        )
    )
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(
            F.min("component").alias("low")
        )
        hooked = labels.join(seen.withColumnRenamed("a", "node"), "node", "left").select(
            "node", "component", F.least("component", "low").alias("low")
        )
        # A root takes the smallest label that any of its nodes has seen: trees merge as a whole.
        roots = hooked.groupBy("component").agg(F.min("low").alias("to"))
        moved = hooked.join(roots, "component").select(
            "node", "component", F.least("low", "to").alias("new")
        )
        jump = moved.select(F.col("node").alias("new"), F.col("new").alias("next"))
        fresh = stored(
            moved.join(jump, "new", "left").select(
                "node",
                F.coalesce("next", "new").alias("fresh"),
                (F.coalesce("next", "new") != F.col("component")).alias("changed"),
            )
        )
        labels = fresh.select("node", F.col("fresh").alias("component"))
        if fresh.where("changed").limit(1).count() == 0:
            return labels
