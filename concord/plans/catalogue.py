"""All registered queries over the star-schema tables."""

from __future__ import annotations

from . import entities, event_rules, files, metrics, reports, scan, state, transforms, writes  # noqa: F401
from .registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
