"""All registered queries."""

from __future__ import annotations

from plantlens.registry import (  # noqa: F401
    checks,
    ingest,
    joining,
    maintenance,
    products,
    shaping,
)
from plantlens.registry.core import QUERIES

__all__ = ["QUERIES"]
