"""Compare the contents of two tables, and find the rows that differ.

A fingerprint of a set of rows is the number of rows and two sums of row hashes. Sums do not depend
on the order of the rows, can be made in parts, and those of source and target cancel out: both
sides go through one aggregate, with opposite signs, and what is left of a batch is zero if its rows
are equal. Batches that differ are then cut into ranges of a key, again and again, and only ranges
whose sums do not cancel are looked into, until they hold few rows.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchload.operators.project import quoted

#: A range is cut into 16, so by four bits of the key's distance from the least one.
BITS = 4
#: Ranges of up to so many rows are compared row by row.
LEAF_ROWS = 256


def row_hashes(columns: list[str]) -> list[Column]:
    """Two hashes of a row. Hashing passes over nulls, so whether a value is null is hashed too."""
    values = [part for name in columns for part in (F.col(quoted(name)), F.col(quoted(name)).isNull())]
    return [F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)") for seed in (1, 2)]


def _sides(
    source: DataFrame, target: DataFrame, by: list[str], columns: list[str], key: str | None
) -> DataFrame:
    """Both tables as (by, key, h1, h2, side); side is 1 for rows of the source, -1 for others."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        h1, h2 = row_hashes(columns)
        keys = [] if key is None else [F.col(quoted(key)).cast("long").alias("__key")]
        return df.select(
            *map(quoted, by), *keys, h1.alias("__h1"), h2.alias("__h2"), F.lit(sign).alias("__side")
        )

    return side(source, 1).unionAll(side(target, -1))


def _sums() -> list[Column]:
    return [
        F.count_if(F.col("__side") == 1).alias("source_rows"),
        F.count_if(F.col("__side") == -1).alias("target_rows"),
        F.sum(F.col("__h1") * F.col("__side")).alias("__d1"),
        F.sum(F.col("__h2") * F.col("__side")).alias("__d2"),
    ]


_DIFFERS = "source_rows <> target_rows OR __d1 <> 0 OR __d2 <> 0"


def reconcile_contents(
    source: DataFrame, target: DataFrame, by: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Compare the rows of source and target in each group of `by`, by their `columns` (by default
    all others that the source has).

    `status` is `ok`, `differs`, `missing_in_target` or `missing_in_source`; groups of equal counts
    and different rows differ. Rows are compared with their number: a row that is there twice is not
    a row that is there once. Columns go by name, their types should be the same. Nulls are equal to
    nulls, and to nothing else.
    """
    columns = columns or [name for name in source.columns if name not in by]
    sums = _sides(source, target, by, columns, None).groupBy(*map(quoted, by)).agg(*_sums())
    return sums.select(
        *map(quoted, by),
        F.nullif("source_rows", F.lit(0)).alias("source_rows"),
        F.nullif("target_rows", F.lit(0)).alias("target_rows"),
        F.when(F.col("target_rows") == 0, "missing_in_target")
        .when(F.col("source_rows") == 0, "missing_in_source")
        .when(F.expr(_DIFFERS), "differs")
        .otherwise("ok")
        .alias("status"),
    )


def differing_rows(
    source: DataFrame,
    target: DataFrame,
    by: list[str],
    key: str,
    work_path: str,
    columns: list[str] | None = None,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(by, key, status, source_rows, target_rows): the keys whose rows are not the same on both
    sides, with the rows that have no equal on the other.

    `key` is a whole number and may repeat or be null. `status` is `changed`, `missing_in_target` or
    `missing_in_source`. Ranges that still differ are kept under `work_path`, one folder a cut; both
    tables are read once for each cut, and only rows of differing ranges are looked at. Batches that
    have no equal at all are found in as few cuts, as all their ranges differ: for those
    `reconcile_contents` says enough.
    """
    columns = columns or [name for name in source.columns if name not in by]
    spark = source.sparkSession
    rows = _sides(source, target, by, columns, key)

    def kept(df: DataFrame) -> DataFrame:
        path = os.path.join(work_path, uuid.uuid4().hex)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def place(level: int) -> Column:
        """The range of a key after so many cuts; null keys have a range of their own."""
        bits = F.greatest(F.col("__bits") - level * BITS, F.lit(0))
        width = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
        far = F.call_function("div", F.try_subtract("__key", "__low"), width)
        return F.coalesce(far, F.lit(-1))

    def same(one: DataFrame, other: DataFrame, more: list[str]) -> Column:
        pairs = [one[name].eqNullSafe(other[name]) for name in (*by, *more)]
        return reduce(Column.__and__, pairs)

    def inside(ranges: DataFrame, level: int) -> DataFrame:
        """Rows of the ranges that are left after so many cuts. The first range is the batch."""
        if level == 0:
            return rows.join(ranges, same(rows, ranges, [])).select(
                *[rows[name] for name in rows.columns], "__low", "__bits"
            )
        known = ranges.select(*by, "__low", "__bits").distinct()
        placed = rows.join(known, same(rows, known, [])).select(
            *[rows[name] for name in rows.columns], "__low", "__bits"
        )
        placed = placed.withColumn("__range", place(level))
        wanted = ranges.select(*by, "__range")
        found = placed.join(wanted, same(placed, wanted, ["__range"]), "left_semi")
        return found.drop("__range")

    # Batches that differ, the least key of each and the bits that its keys reach over.
    whole = rows.groupBy(*map(quoted, by)).agg(
        *_sums(), F.min("__key").alias("__low"), F.max("__key").alias("__high")
    )
    span = F.col("__high").cast("double") - F.col("__low").cast("double") + 1
    bits = F.ceil(F.log2(span) / BITS).cast("int") * BITS + BITS
    ranges = kept(
        whole.where(_DIFFERS).select(
            *map(quoted, by),
            "__low",
            F.coalesce(F.least(bits, F.lit(60)), F.lit(0)).alias("__bits"),
            F.lit(0).cast("long").alias("__range"),
            (F.col("source_rows") + F.col("target_rows")).alias("__n"),
        )
    )
    leaves, level = [], 0
    while True:
        small = (F.col("__n") <= leaf_rows) | (F.col("__bits") <= level * BITS)
        leaves.append(inside(ranges.where(small), level))
        ranges = ranges.where(~small)
        if not ranges.limit(1).count():
            break
        within = inside(ranges, level)
        level += 1
        placed = within.withColumn("__range", place(level))
        sums = placed.groupBy(*map(quoted, by), "__low", "__bits", "__range").agg(*_sums())
        ranges = kept(
            sums.where(_DIFFERS).select(
                *map(quoted, by),
                "__low",
                "__bits",
                "__range",
                (F.col("source_rows") + F.col("target_rows")).alias("__n"),
            )
        )
    left = reduce(DataFrame.unionAll, leaves)
    net = left.groupBy(*map(quoted, by), "__key", "__h1", "__h2").agg(F.sum("__side").alias("__net"))
    found = net.where("__net <> 0").groupBy(*map(quoted, by), F.col("__key").alias(key)).agg(
        F.sum(F.greatest("__net", F.lit(0))).alias("source_rows"),
        F.sum(F.greatest(-F.col("__net"), F.lit(0))).alias("target_rows"),
    )
    return found.withColumn(
        "status",
        F.when(F.col("target_rows") == 0, "missing_in_target")
        .when(F.col("source_rows") == 0, "missing_in_source")
        .otherwise("changed"),
    )
