"""Import every query module so that the registry is complete."""

from __future__ import annotations

from skydrift.plans import (  # noqa: F401
    drift_queries,
    feature_queries,
    log_queries,
    metric_queries,
    model_queries,
    sampling_queries,
    staging_queries,
    stored_queries,
    stream_queries,
)
from skydrift.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
