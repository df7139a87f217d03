"""All registered queries and their SQL twins."""

from __future__ import annotations

from proteoframe.plans import (
    biophys_queries, io_queries, model_queries, msa_queries, report_queries, run_queries, sequence_queries,
    structure_queries)

MODULES = (sequence_queries, biophys_queries, msa_queries, run_queries, structure_queries,
           model_queries, io_queries, report_queries)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.CATALOG.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.CATALOG.sql.items()}
