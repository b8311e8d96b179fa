"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many points of a ring of hashes; a key belongs to the shard of the first point
clockwise from its own hash. No shard takes more than `1 + slack` times the mean: what does not fit
goes on clockwise to the next shard with room. So sizes are near equal, and a ring with one shard
more leaves most rows where they were.

Rows meet the ring in units: an arc of the ring, of which there are 2 to the power of ARC_BITS, or a
part of a key that is heavy, so of a text with very many copies. Spark sums the units; their sums,
a table bounded whatever the input, are filled into the ring; Spark takes the shard of a unit back
to its rows and numbers them. Rows of equal keys stay together as long as their shard has room; a
key larger than a part of a shard is cut and fills its shard first, then the next.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchload.llm.common import stored
from batchload.llm.ranking import laid_out, ranked

#: Arcs that the ring is cut into.
ARC_BITS = 18
#: Points of a shard on the ring.
POINTS = 256
#: A key is heavy above this part of a shard, by size or by rows. There can be no more heavy keys
#: than twice the shards times this.
HEAVY_PART = 64
#: Heavy keys are cut into pieces of about a quarter of that.
PIECES = 4
#: How far a shard may be above the mean.
SLACK = 0.001


def ring(n_shards: int, points: int = POINTS) -> tuple[list[int], np.ndarray]:
    """The points in order, and for each the shards in the order met from there clockwise."""
    spots = sorted(
        (int.from_bytes(sha256(f"{shard}:{k}".encode()).digest()[:8]), shard)
        for shard in range(n_shards)
        for k in range(points)
    )
    order = np.empty((len(spots), n_shards), np.int32)
    ahead: list[int] = []
    for i in reversed(range(2 * len(spots))):
        shard = spots[i % len(spots)][1]
        if shard in ahead:
            ahead.remove(shard)
        ahead.insert(0, shard)
        if i < len(spots):
            order[i] = ahead
    return [spot for spot, _ in spots], order


def fill(spots: list[int], sizes: list[int], n_shards: int, slack: float = SLACK) -> np.ndarray:
    """The shard of every unit, given its place on the ring and its size, in the order given.

    A unit that no shard has room for, as it is larger than what is left anywhere, goes to the
    smallest shard.
    """
    points, order = ring(n_shards)
    room = np.full(n_shards, sum(sizes) * (1 + slack) / n_shards).tolist()
    shards = np.empty(len(sizes), np.int32)
    for i, (spot, size) in enumerate(zip(spots, sizes)):
        for shard in order[bisect_left(points, spot) % len(points)].tolist():
            if room[shard] >= size:
                break
        else:
            shard = max(range(n_shards), key=room.__getitem__)
        room[shard] -= size
        shards[i] = shard
    return shards


def _unsigned(values: pd.Series) -> np.ndarray:
    return values.to_numpy(np.int64).view(np.uint64)


def _heavy(rows: DataFrame, keys: list[str], size: float, n: float) -> DataFrame:
    """Keys above a size or a number of rows: no more than total over limit, of each."""
    sums = rows.groupBy(*keys).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    pieces = F.greatest(F.col("bytes") / size, F.col("n") / n)
    return sums.where(pieces > 1).select(*keys, F.ceil(pieces * PIECES).alias("pieces"))


def assign(
    df: DataFrame, key: Column, size: Column, n_shards: int, slack: float = SLACK
) -> DataFrame:
    """`df` with the `shard` of every row and its `slot` there, both from zero, slots without gaps.

    `key` says what belongs together, `size` is what shards are balanced by, a whole number above
    zero. Null keys are one key. Rows that are equal in all columns may stand for one another. A
    column of `df` that is called shard or slot is replaced. A table without rows gives none. With
    sizes as large as shards there is no balance to be had: such a row goes where there is room, or
    to the smallest shard.
    """
    rows = stored(
        df.select(
            F.struct("*").alias("row"),
            F.xxhash64(key).alias("spot"),
            F.xxhash64(F.lit(1), *[F.col(f"`{name}`") for name in df.columns]).alias("pick"),
            size.cast("long").alias("size"),
            F.monotonically_increasing_id().alias("number"),
        )
    )
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    parts = n_shards * HEAVY_PART
    limits = max(1.0, (total or 0) / parts), max(1.0, n / parts)
    heavy = _heavy(rows, ["spot"], *limits).orderBy("spot").toPandas()
    heavy["base"] = (1 << ARC_BITS) + heavy["pieces"].cumsum() - heavy["pieces"]
    spark = df.sparkSession
    cut = spark.createDataFrame(heavy, "spot long, pieces long, base long")
    split = rows.join(F.broadcast(cut), "spot", "left")
    equal = stored(_heavy(split.where("base IS NOT NULL"), ["spot", "pick"], *limits))
    whole = split.withColumn("part", F.col("pick"))
    if equal.limit(1).count():
        # Rows that are equal in all columns, as many as make a key heavy, are dealt out in turn.
        alike = F.broadcast(equal.select("spot", "pick"))  # no more of them than of heavy keys
        places = laid_out(split.join(alike, ["spot", "pick"]), ["pick", "number"])
        dealt = ranked(places, "pick").withColumn("part", F.col("rank")).select(whole.columns)
        whole = whole.join(alike, ["spot", "pick"], "left_anti").unionByName(dealt)
    unit = F.coalesce(
        F.col("base") + F.expr("pmod(part, pieces)"),
        F.shiftrightunsigned("spot", 64 - ARC_BITS),
    )
    units = whole.select("row", "spot", "pick", "number", "size", unit.alias("unit"))
    sums = units.groupBy("unit").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("spot").alias("spot")
    ).toPandas()
    plan = spark.createDataFrame(
        _plan(sums, n_shards, slack), "unit long, shard int, before long"
    )
    inside = Window.partitionBy("unit").orderBy("spot", "pick", "number")
    placed = units.join(F.broadcast(stored(plan)), "unit").withColumn(
        "slot", F.col("before") + F.row_number().over(inside) - 1
    )
    kept = [name for name in df.columns if name not in ("shard", "slot")]
    return placed.select(*[F.col(f"row.`{name}`") for name in kept], "shard", "slot")


def _plan(sums: pd.DataFrame, n_shards: int, slack: float) -> pd.DataFrame:
    """(unit, shard, before) from the sums of all units: `before` is the slot of the first row."""
    arc = sums["unit"].to_numpy() < 1 << ARC_BITS
    start = sums["unit"].to_numpy().astype(np.uint64) << np.uint64(64 - ARC_BITS)
    spot = np.where(arc, start, _unsigned(sums["spot"]))
    # Pieces of heavy keys first, while there is room to keep them together; then arcs in an order
    # that has nothing to do with their places.
    mixed = spot * np.uint64(0x9E3779B97F4A7C15)
    order = np.lexsort((sums["unit"], mixed, arc))
    sums = sums.iloc[order].reset_index(drop=True)
    sums["shard"] = fill(spot[order].tolist(), sums["size"].tolist(), n_shards, slack)
    sums = sums.sort_values(["shard", "unit"])
    sums["before"] = sums.groupby("shard")["n"].cumsum() - sums["n"]
    return sums[["unit", "shard", "before"]]
