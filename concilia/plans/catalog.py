"""Every registered query of the reconciliation engine, with its SQL."""

from __future__ import annotations

from . import agenda, cells, jobs, relations, reports, scalars
from . import flagship as full

MODULES = [scalars, relations, jobs, full, agenda, cells, reports]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
flagship = full.full_pipeline
