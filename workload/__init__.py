"""Registered queries: every operator over the given tables, with its SQL twin."""

from . import feeds, hostile, incremental, scans, shapes, streams, tables  # noqa: F401 - they register themselves
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
