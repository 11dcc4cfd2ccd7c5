"""All queries of the library and their SQL."""

from __future__ import annotations

from velonet.plans import attribute_queries, geometry_queries  # noqa: F401  they register themselves
from velonet.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
