"""Registered queries over the given tables."""

from lumenfold.plans import cluster_queries, retrieval_queries, shape_queries, source_queries  # noqa: F401
from lumenfold.plans.registry import ORACLES, QUERIES  # noqa: F401
