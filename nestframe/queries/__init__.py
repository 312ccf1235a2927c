"""One query per operator on the sample tables, each with the SQL that says what it must give."""

from nestframe.queries import checks, fetching, flat, rebuilding, shredding, storing  # noqa: F401
from nestframe.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
