"""A zone map: the least and the greatest time of every file of a table.

Spark prunes by folders and, for some types, by the row groups of files it has opened; a zone map
says which files a plan needs before any is opened. It covers the types that Parquet filters skip
nothing by, and any layout that keeps near times in few files.
"""

from __future__ import annotations

import re
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchload.functions.patterns import ntz_literal
from batchload.plans.batch_plan import BatchPlan

ZONE_SCHEMA = (
    "file string, least timestamp_ntz, greatest timestamp_ntz, n_rows bigint, n_null bigint"
)
#: Ranges of a plan that files are compared with one by one; of more, neighbours count as one.
MAX_RANGES = 2_000


def zones(rows: DataFrame, time_col: str) -> DataFrame:
    """One row for each file with rows, from the time column alone. `rows` is a scan of files."""
    ts = F.col(time_col).cast("timestamp_ntz")
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(ts).alias("least"),
        F.max(ts).alias("greatest"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ts.isNull()).alias("n_null"),
    )


def update(spark: SparkSession, map_path: str, data_path: str, time_col: str) -> DataFrame:
    """The zone map at `map_path`, with the files of the table that it does not know yet.

    Only new files are scanned. Rows of files that are gone stay and do no harm: `pick` reads none.
    """
    rows = spark.read.parquet(data_path)
    old = _files(_known(spark, map_path))
    new = [file for file in rows.inputFiles() if _spelled(file) not in old]
    if new:
        fresh = spark.read.option("basePath", data_path).schema(rows.schema).parquet(*map(_path, new))
        zones(fresh, time_col).coalesce(1).write.mode("append").parquet(map_path)
    return _known(spark, map_path)


def _known(spark: SparkSession, map_path: str) -> DataFrame:
    try:
        return spark.read.schema(ZONE_SCHEMA).parquet(map_path)
    except PySparkException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ZONE_SCHEMA)


def _spelled(file: str) -> str:
    """A file's name in one spelling: Spark has several, with `file:/` and `file:///`, escaped or
    not."""
    return re.sub(r"^file:/+", "file:/", unquote(file))


def _path(listed: str) -> str:
    """A listed file as a path to read: not escaped, and no pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(listed))


def _files(zone_map: DataFrame) -> set[str]:
    return {_spelled(row["file"]) for row in zone_map.select("file").collect()}


def ranges(plan: BatchPlan) -> list[tuple[datetime | None, datetime | None]]:
    """Disjoint ranges of time that hold all batches, in order, at most MAX_RANGES."""
    spans = sorted(
        ((plan.lower(item), plan.upper(item)) for item in plan.items),
        key=lambda span: (span[0] is not None, span[0] or datetime.min),
    )
    merged: list[tuple[datetime | None, datetime | None]] = []
    for low, high in spans:
        if merged and (merged[-1][1] is None or low is None or low <= merged[-1][1]):
            last = merged[-1]
            merged[-1] = (last[0], None if None in (last[1], high) else max(last[1], high))
        else:
            merged.append((low, high))
    if len(merged) > MAX_RANGES:
        edges = [i * len(merged) // MAX_RANGES for i in range(MAX_RANGES + 1)]
        merged = [(merged[a][0], merged[b - 1][1]) for a, b in zip(edges, edges[1:])]
    return merged


def needed(zone_map: DataFrame, plan: BatchPlan) -> DataFrame:
    """The files that may hold rows of the plan. A batch without bounds needs every file."""
    far = [(low or datetime.min, high or datetime.max) for low, high in ranges(plan)]
    spans = F.array(
        *[F.struct(ntz_literal(a).alias("low"), ntz_literal(b).alias("high")) for a, b in far]
    )
    meets = F.exists(
        spans, lambda s: (F.col("greatest") >= s["low"]) & (F.col("least") < s["high"])
    )
    whole = any(low is None and high is None for low, high in ranges(plan))
    return zone_map.where(F.lit(True) if whole else meets if far else F.lit(False))


def pick(rows: DataFrame, zone_map: DataFrame, plan: BatchPlan, data_path: str) -> DataFrame:
    """The table `rows`, read from the files that the plan needs; others are not opened.

    Files that the zone map does not know are read, so that a map that lags behind loses no rows.
    """
    spark, known, wanted = rows.sparkSession, _files(zone_map), _files(needed(zone_map, plan))
    files = [
        file
        for file in rows.inputFiles()
        if _spelled(file) in wanted or _spelled(file) not in known
    ]
    if not files:
        return rows.where(F.lit(False))
    return spark.read.option("basePath", data_path).schema(rows.schema).parquet(*map(_path, files))
