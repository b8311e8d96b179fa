"""Batch planning: from a request to a plan of half-open batches."""

from batchload.plans.batch_plan import BatchPlan, PlanItem
from batchload.plans.builder import build, partitions, tumbling

__all__ = ["BatchPlan", "PlanItem", "build", "partitions", "tumbling"]
