"""Every query of the engine on the driver's tables, with its DuckDB oracle."""

from __future__ import annotations

from tesserae.plans import queries_integration, queries_maps, queries_qc, queries_tables  # noqa: F401
from tesserae.plans.registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
