"""Operators on documents, pages and vectors for preparing training data."""

from tabloom.llm import queries  # noqa: F401
from tabloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
