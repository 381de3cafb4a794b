"""The engine's queries and, where SQL can say the same, their SQL for another engine."""

from __future__ import annotations

from .reports import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
