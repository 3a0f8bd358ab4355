"""All queries of the core operators and their SQL equivalents."""

from __future__ import annotations

from sheafline.plans import contract, documents, gateway, geometry, intake, ladder, pages, sheets, state
from sheafline.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
for _module in (intake, gateway, documents, contract, geometry, pages, state, ladder, sheets):
    QUERIES |= _module.R.queries
    SQL |= _module.R.sql
