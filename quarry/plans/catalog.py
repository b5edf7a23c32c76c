"""Imports every plan module so the registry is complete."""

from quarry.plans import board, corpus, extras, gauges, logs, streams, trials, vectors  # noqa: F401
from quarry.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
