"""Registered queries, each beside the equivalent SQL that checks it."""

from millrace.plans import (  # noqa: F401  (importing registers the queries)
    aggregates,
    documents,
    experiments,
    expressions,
    features,
    joins,
    large,
    lifecycle,
    models,
    monitoring,
    ordering,
    storage,
    streams,
)
from millrace.plans.registry import COVERS, ORACLES, QUERIES

__all__ = ["COVERS", "ORACLES", "QUERIES"]
