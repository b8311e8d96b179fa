"""Places of rows within their groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchload.llm.common import stored

#: `monotonically_increasing_id` counts the rows of a partition in its lower 33 bits.
PIECE_BITS = 33


def piece(at: str = "at") -> Column:
    """The piece that a row of `laid_out` lies in."""
    return F.shiftright(at, PIECE_BITS)


def laid_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """`df` written in the order of `keys` (nulls first), with the place `at` of every row.

    The order is cut into pieces by ranges of all keys, so a group of equal first keys lies in as
    many pieces as its size asks for. Places of one piece are consecutive. `df` is read twice.
    """
    order = [F.col(key).asc_nulls_first() for key in keys]
    return stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
    )


def runs(rows: DataFrame, group: str) -> DataFrame:
    """(group, piece, first, total): one row for each piece that a group lies in.

    A row of the group at `at` has rank `at - first`, from zero; `total` is the group's size.
    """
    per_piece = rows.groupBy(F.col(group), piece().alias("piece")).agg(
        F.min("at").alias("low"), F.count(F.lit(1)).alias("here")
    )
    whole = Window.partitionBy(group)
    before = F.sum("here").over(whole.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    return per_piece.select(
        group,
        "piece",
        (F.col("low") - F.coalesce(before, F.lit(0))).alias("first"),
        F.sum("here").over(whole).alias("total"),
    )


def ranked(rows: DataFrame, group: str, found: DataFrame | None = None) -> DataFrame:
    """`laid_out` rows with their `rank` in the group, from zero, and the group's `total`.

    `found` is `runs(rows, group)`, or that with more columns for the rows to get. Joined by group
    and piece, so no task gets more of a group than one piece holds.
    """
    found = runs(rows, group) if found is None else found
    found = found.withColumnsRenamed({group: "__group", "piece": "__piece"})
    same = rows[group].eqNullSafe(found["__group"]) & (piece() == found["__piece"])
    return (
        rows.join(found, same)
        .withColumn("rank", F.col("at") - F.col("first"))
        .drop("__group", "__piece", "first", "at")
    )
