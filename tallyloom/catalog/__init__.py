"""Registered queries with their equivalent SQL."""

from tallyloom.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "load"]


def load() -> None:
    """Import the modules that register queries."""
    from tallyloom.catalog import cleaning, grids, groups, idents, io, jobs, joins, panels, scalars  # noqa: F401
