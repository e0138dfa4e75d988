"""The registered queries. Importing the package registers them all."""

from punctua.catalog import core, reporting, scalar, shared, statistics  # noqa: F401
from punctua.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
