"""Queries over the supplied tables, one or more per operator."""

from hazardlake.queries import (  # noqa: F401
    documents,
    events,
    files,
    indicators,
    lookups,
    quality,
    streams,
)
from hazardlake.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
