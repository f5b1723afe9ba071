"""All registered queries."""

from __future__ import annotations

from millrace.plans import changes, ordered, rows, services, stateful, streams, windows  # noqa: F401
from millrace.plans.registry import QUERIES

__all__ = ["QUERIES"]
