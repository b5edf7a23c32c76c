"""Registry of named queries and their DuckDB oracle text.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables. The
oracle text is plain SQL over the same tables; the fixture views it uses are
prefixed as CTEs automatically.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from quarry.oracle.views import VIEW_SQL, with_views

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_VIEW_RE = re.compile(r"\b(" + "|".join(VIEW_SQL) + r")\b")


def register(name: str, sql: str | None = None):
    """Decorator: register a query under ``name`` with optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *sorted(set(_VIEW_RE.findall(sql))))
        return fn
    return deco
