"""All registered queries and their checking SQL, section by section."""

from __future__ import annotations

from workload import analytics, ingestion, operations, quality, text

_SECTIONS = (analytics, ingestion, quality, text, operations)

QUERIES = {name: query for section in _SECTIONS for name, query in section.QUERIES.items()}
ORACLES = {name: sql for section in _SECTIONS for name, sql in section.ORACLES.items()}
