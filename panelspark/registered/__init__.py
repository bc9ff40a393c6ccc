"""All named queries."""

from . import aggregates, columns, joins, landing, models, serving, windows  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
