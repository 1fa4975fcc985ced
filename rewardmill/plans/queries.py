"""All registered queries of the engine and their DuckDB equivalents."""

from __future__ import annotations

from rewardmill.plans import catalog, catalog_features, catalog_files  # noqa: F401 - they register

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
