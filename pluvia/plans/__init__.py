"""Query registry: Spark plans next to the SQL that checks them."""

from pluvia.plans import (  # noqa: F401
    aggregates,
    joins,
    models,
    projections,
    quality,
    risk,
    sinks,
    sources,
    streams,
    windows,
)
from pluvia.plans.registry import QUERIES

__all__ = ["QUERIES"]
