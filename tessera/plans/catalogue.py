"""the registered queries, each with its DuckDB twin."""

from __future__ import annotations

from tessera.plans import control, evals, flow, identity, lookups, runs  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES  # noqa: F401
