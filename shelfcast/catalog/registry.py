"""Importing this module registers every query."""

from __future__ import annotations

from shelfcast.catalog import (  # noqa: F401
    aggregates,
    inventory,
    joins,
    modeling,
    projections,
    selections,
    sources,
    windows,
)
from shelfcast.catalog.base import QUERIES

__all__ = ["QUERIES"]
