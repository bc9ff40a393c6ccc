"""All queries of this folder."""

from . import conversations, decontaminate, likelihood, mixing, phrases, quality, repair, runs, simhash, suffixes, toxicity, urls, vectors  # noqa: F401
from .tables import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
