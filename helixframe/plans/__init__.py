"""Registered queries and their SQL twins."""

from helixframe.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
