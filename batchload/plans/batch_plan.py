"""The plan of a load.

A plan is a short list of items, one per bound or partition the caller wrote, and stands for all
batches of those items in closed form: batch *k* of an item starts *k* intervals after the item's
origin. So the plan of ten batches and of a hundred million batches is the same size on the driver,
and a row finds its batch by arithmetic instead of by a range join. `frame` lists the batches as a
DataFrame for everything that needs one row per batch.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchload.functions.patterns import (
    CALENDAR_MONTHS,
    UNIT_SECONDS,
    floor_column,
    floor_to_unit,
    format_column,
)

PLAN_COLUMNS = ["batch_id", "kind", "start_ts", "end_ts", "start_text", "end_text", "partition"]
WINDOWED = ("range", "partition_range")

# Batches listed by one input row of `frame`; larger plans are spread over tasks in such chunks.
CHUNK = 100_000


@dataclass(frozen=True)
class PlanItem:
    """A run of consecutive batches. Windows `first_window ..` of an item begin at `origin`."""

    kind: str
    n_batches: int
    partition: str | None = None
    origin: datetime | None = None
    stop: datetime | None = None
    first_window: int = 0
    first_batch_id: int = 0

    @property
    def last_batch_id(self) -> int:
        return self.first_batch_id + self.n_batches - 1


@dataclass(frozen=True)
class BatchPlan:
    items: tuple[PlanItem, ...]
    pattern: str
    unit: str
    interval_seconds: int | None = None
    clamp_end: bool = False

    @property
    def n_batches(self) -> int:
        return sum(item.n_batches for item in self.items)

    @property
    def cuts_bounds(self) -> bool:
        """Whether bounds lose something as text: the pattern is coarser than the interval."""
        if self.unit in CALENDAR_MONTHS:
            return True
        return self.interval_seconds % UNIT_SECONDS.get(self.unit, 1) != 0

    def lower(self, item: PlanItem) -> datetime | None:
        """Start of the item's first batch."""
        if item.kind in WINDOWED:
            return self._cursor(item, item.first_window)
        return item.origin

    def upper(self, item: PlanItem) -> datetime | None:
        """End of the item's last batch."""
        if item.kind in WINDOWED:
            end = self._cursor(item, item.first_window + item.n_batches)
            return min(end, item.stop) if self.clamp_end else end
        return item.stop

    def _cursor(self, item: PlanItem, window: int) -> datetime:
        raw = item.origin + timedelta(seconds=window * self.interval_seconds)
        return floor_to_unit(raw, self.unit)

    def between(self, first: int, last: int) -> "BatchPlan":
        """The part of the plan with batch ids `first` to `last`; ids stay as they are."""
        kept = []
        for item in self.items:
            lo, hi = max(first, item.first_batch_id), min(last, item.last_batch_id)
            if lo <= hi:
                kept.append(
                    replace(
                        item,
                        n_batches=hi - lo + 1,
                        first_window=item.first_window + lo - item.first_batch_id,
                        first_batch_id=lo,
                    )
                )
        return replace(self, items=tuple(kept))

    def split(self, num_slices: int) -> list["BatchPlan"]:
        """Cut into at most `num_slices` runs of contiguous batches of near-equal number."""
        if num_slices < 1:
            raise ValueError("num_slices must be positive")
        total = self.n_batches
        n = min(num_slices, total)
        pieces: list[list[PlanItem]] = [[] for _ in range(n)]
        position = 0
        for item in self.items:
            done = 0
            while done < item.n_batches:
                slice_no = position * n // total
                slice_end = -(-(slice_no + 1) * total // n)
                take = min(item.n_batches - done, slice_end - position)
                pieces[slice_no].append(
                    replace(
                        item,
                        n_batches=take,
                        first_window=item.first_window + done,
                        first_batch_id=item.first_batch_id + done,
                    )
                )
                done += take
                position += take
        return [replace(self, items=tuple(piece)) for piece in pieces]

    def fragments(self, num_slices: int) -> list["BatchPlan"]:
        """Like `split`, but with one item in each part, so that a part has a single pair of
        bounds and a single partition."""
        pieces = self.split(num_slices)
        return [replace(self, items=(item,)) for piece in pieces for item in piece.items]

    def hull(self) -> tuple[datetime | None, datetime | None]:
        """Smallest range that holds all batches; None where the plan is open."""
        lowers = [self.lower(item) for item in self.items]
        uppers = [self.upper(item) for item in self.items]
        return (
            None if None in lowers else min(lowers, default=None),
            None if None in uppers else max(uppers, default=None),
        )

    def layers(self, keys: dict[str, object] | None = None) -> list["BatchPlan"]:
        """Split into plans within which no row can belong to two items.

        Items of different partitions never overlap; an open range, or a second entry for the same
        partition, may. `keys` says which names are the same partition once they are values of its
        column. Used where a source is read once per layer.
        """
        keys = keys or {}
        layers: list[list[PlanItem]] = []
        seen: dict[object, int] = {}
        whole = [item for item in self.items if item.partition is None]
        for item in self.items:
            if item.partition is not None:
                key = keys.get(item.partition, item.partition)
                depth = seen.get(key, 0)
                seen[key] = depth + 1
                if depth == len(layers):
                    layers.append([])
                layers[depth].append(item)
        parts = [[item] for item in whole] + layers
        return [replace(self, items=tuple(part)) for part in parts]

    def items_frame(self, spark: SparkSession) -> DataFrame:
        """One row per item; a local relation, as large as the request text."""
        rows = [
            (
                i.kind,
                i.partition,
                i.origin,
                i.stop,
                self.lower(i),
                self.upper(i),
                i.first_window,
                i.n_batches,
                i.first_batch_id,
            )
            for i in self.items
        ]
        text, time, number = pa.string(), pa.timestamp("us"), pa.int64()
        types = [text, text, time, time, time, time, number, number, number]
        names = [
            "kind",
            "partition",
            "origin",
            "stop",
            "lower",
            "upper",
            "first_window",
            "n_batches",
            "first_batch_id",
        ]
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        table = pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})
        return spark.createDataFrame(
            table,
            "kind string, partition string, origin timestamp_ntz, stop timestamp_ntz, "
            "lower timestamp_ntz, upper timestamp_ntz, first_window bigint, n_batches bigint, "
            "first_batch_id bigint",
        )

    def frame(self, spark: SparkSession) -> DataFrame:
        """The plan as a DataFrame, one row per batch."""
        chunks = self.items_frame(spark).withColumn(
            "chunk", F.explode(F.expr(f"sequence(0L, (n_batches - 1) div {CHUNK})"))
        )
        if self.n_batches > CHUNK:
            chunks = chunks.repartition(-(-self.n_batches // CHUNK))
        rows = chunks.withColumn(
            "offset",
            F.explode(
                F.expr(
                    f"sequence(chunk * {CHUNK}, least(n_batches, (chunk + 1) * {CHUNK}) - 1)"
                )
            ),
        )
        start, end = F.col("origin"), F.col("stop")
        if self.interval_seconds:
            step = F.expr(f"INTERVAL '{self.interval_seconds}' SECOND")
            window = F.col("first_window") + F.col("offset")
            windowed = F.col("kind").isin(*WINDOWED)
            begin = F.col("origin") + step * window
            next_begin = F.col("origin") + step * (window + 1)
            if self.cuts_bounds:
                begin, next_begin = (floor_column(c, self.unit) for c in (begin, next_begin))
            if self.clamp_end:
                next_begin = F.least(next_begin, F.col("stop"))
            start = F.when(windowed, begin).otherwise(start)
            end = F.when(windowed, next_begin).otherwise(end)
        return (
            rows.withColumn("batch_id", F.col("first_batch_id") + F.col("offset"))
            .withColumn("start_ts", start)
            .withColumn("end_ts", end)
            .withColumn("start_text", format_column(F.col("start_ts"), self.pattern))
            .withColumn("end_text", format_column(F.col("end_ts"), self.pattern))
            .select(*PLAN_COLUMNS)
        )
