"""All queries of the library and their SQL."""

from __future__ import annotations

from loamgrid.plans import cell_queries, model_queries  # noqa: F401  (they register their queries)
from loamgrid.plans.bindings import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
