"""Windowed batch extract-and-load on Spark."""

from batchload.plans import BatchPlan, build, partitions, tumbling
from batchload.request import BatchRequest

__all__ = ["BatchPlan", "BatchRequest", "build", "partitions", "tumbling"]
