"""All registered queries and their checking SQL."""

from eventide.catalog import journeys, reports, streams  # noqa: F401  (they register on import)
from eventide.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
