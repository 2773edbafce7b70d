"""Named queries over the driver's tables and the SQL that they are held against."""

from __future__ import annotations

from . import curated, decisions, flows, measured, operations, records, relational

QUERIES = relational.QUERIES | measured.QUERIES | curated.QUERIES | operations.QUERIES | records.QUERIES | flows.QUERIES | decisions.QUERIES
ORACLES = relational.ORACLES | measured.ORACLES | curated.ORACLES | operations.ORACLES | records.ORACLES | flows.ORACLES | decisions.ORACLES
