"""From a request to a plan."""

from __future__ import annotations

import logging
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from batchload.functions.patterns import finest_unit, parse_texts
from batchload.plans.batch_plan import BatchPlan, PlanItem
from batchload.request import BatchRequest, is_blank

log = logging.getLogger(__name__)


def build(spark: SparkSession, request: BatchRequest) -> BatchPlan:
    """Plan a request.

    Both bounds: tumbling windows, partitions ignored. Otherwise the batches of the single bound
    and of the partition list follow each other; they are not intersected, so a row may belong to
    several batches.
    """
    request.validate()
    unit = finest_unit(request.pattern)
    if request.has_start and request.has_end:
        if request.has_partitions:
            log.warning("both bounds given: partitions %r are ignored", request.partitions)
        start, end = parse_texts(spark, [request.start, request.end], request.pattern)
        if start >= end:
            raise ValueError(f"start {request.start!r} must lie before end {request.end!r}")
        items = [_windows("range", None, start, end, request.interval_seconds)]
    else:
        items = []
        if request.has_start:
            (start,) = parse_texts(spark, [request.start], request.pattern)
            items.append(PlanItem("start", 1, origin=start))
        if request.has_end:
            (end,) = parse_texts(spark, [request.end], request.pattern)
            items.append(PlanItem("end", 1, stop=end))
        if request.has_partitions:
            items += _partition_items(spark, request)
    numbered, next_id = [], 0
    for item in items:
        if item.n_batches:
            numbered.append(replace(item, first_batch_id=next_id))
            next_id += item.n_batches
    plan = BatchPlan(
        tuple(numbered), request.pattern, unit, request.interval_seconds, request.clamp_end
    )
    log.info("planned %d batches for %s", plan.n_batches, request.name)
    return plan


def tumbling(
    spark: SparkSession,
    start: str,
    end: str,
    pattern: str,
    interval_seconds: int,
    clamp_end: bool = False,
) -> BatchPlan:
    """Windows of `interval_seconds` from `start`; the last may pass `end` unless clamped."""
    return build(
        spark,
        BatchRequest(
            name="tumbling",
            pattern=pattern,
            start=start,
            end=end,
            interval_seconds=interval_seconds,
            clamp_end=clamp_end,
        ),
    )


def partitions(
    spark: SparkSession, spec: str, pattern: str, interval_seconds: int | None = None
) -> BatchPlan:
    """One batch per named partition, or windows inside it for `name:start-end` entries."""
    return build(
        spark,
        BatchRequest(
            name="partitions",
            pattern=pattern,
            partitions=spec,
            interval_seconds=interval_seconds,
        ),
    )


def _windows(
    kind: str, partition: str | None, start: datetime, end: datetime, interval: int | None
) -> PlanItem:
    if interval is None:
        raise ValueError("interval_seconds is required to cut a range into windows")
    n = max(0, -((start - end) // timedelta(seconds=interval)))
    return PlanItem(kind, n, partition, start, end)


def _partition_items(spark: SparkSession, request: BatchRequest) -> list[PlanItem]:
    entries, texts = [], []
    for entry in request.partitions.rstrip(",").split(","):
        name, colon, bounds = entry.partition(":")
        if is_blank(name):
            raise ValueError(f"empty partition name in {request.partitions!r}")
        if colon:
            pair = bounds.split("-")
            if len(pair) != 2 or any(is_blank(text) or ":" in text for text in pair):
                raise ValueError(
                    f"{entry!r} is not name:start-end; the pattern may hold neither ':' nor '-'"
                )
            texts += pair
        entries.append((name, bool(colon)))
    times = iter(parse_texts(spark, texts, request.pattern))
    items = []
    for name, ranged in entries:
        if ranged:
            start, end = next(times), next(times)
            if start >= end:
                log.warning("partition %s has an empty range and no batches", name)
            items.append(
                _windows("partition_range", name, start, end, request.interval_seconds)
            )
        else:
            items.append(PlanItem("partition", 1, name))
    return items
