"""Registered queries: each operator run over the given tables, with its SQL check."""

from catalog import annotation, collection, learning, quality, reports, storage  # noqa: F401
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
