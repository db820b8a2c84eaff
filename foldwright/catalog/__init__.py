"""Every registered query, grouped by area."""

from foldwright.catalog import checks, encoders, groups, learned, models, scores, series, splits, streams  # noqa: F401
from foldwright.catalog.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
