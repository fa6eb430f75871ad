"""All queries over the driver tables, and their SQL."""

from __future__ import annotations

from . import assets, lists, pixels, rules, runs, schemas, statistics
from .base import QUERIES, SQL

__all__ = ["assets", "lists", "oracle_sql", "pixels", "queries", "rules", "runs", "schemas", "statistics"]


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
