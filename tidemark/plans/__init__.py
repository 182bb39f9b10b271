"""The registered queries."""

from __future__ import annotations

from tidemark.plans import bar_queries, more_queries, source_queries  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES


def all_queries() -> dict:
    return QUERIES


def all_oracles() -> dict:
    return ORACLES
