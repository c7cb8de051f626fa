"""Queries over the given tables, one per operator, and their DuckDB checks."""

from . import answers, layouts, learning, tables, text  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
