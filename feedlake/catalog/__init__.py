"""Registered queries over the supplied tables, with their SQL twins."""

from feedlake.catalog.queries import QUERIES
from feedlake.catalog.twins import TWINS

__all__ = ["QUERIES", "TWINS"]
