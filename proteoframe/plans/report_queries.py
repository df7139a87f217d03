"""Registered query: all report tables as one committed result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.plans import biophys_queries, io_queries, model_queries, run_queries
from proteoframe.plans.catalog import Catalog
from proteoframe.session import shared_steps
from proteoframe.sources import results

CATALOG = Catalog()
query = CATALOG.query

#: The tables of a report.
TABLES = (
    "run_totals", "candidate_table", "mutated_positions", "warnings_table", "step_table", "multi_evidence",
    "single_evidence", "executive_summary", "top_recommendations", "tier_analysis", "tier_warnings", "liability_table",
    "variant_library", "step_variant_table", "tier_highlight_table", "protein_metrics", "pssm_table", "step_breakdown")
_SOURCES = [m.CATALOG for m in (run_queries, model_queries, biophys_queries)]
QUERIES = {name: fn for c in _SOURCES for name, fn in c.queries.items() if name in TABLES}
SQL = {name: sql for c in _SOURCES for name, sql in c.sql.items() if name in TABLES}

#: What each column of each table holds, whatever its type.
TWIN = " UNION ALL ".join(f"""
SELECT '{name}' AS table_name, column_name, count(*) AS n_values, count(DISTINCT v) AS n_distinct
FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({SQL[name]})) ON COLUMNS(*) INTO NAME column_name VALUE v)
GROUP BY column_name""" for name in TABLES)


#: A value of any column: numbers stay numbers, all else is told as text.
VALUE = {"whole": "bigint", "real": "double", "text": "string"}


def cells(name: str, df: DataFrame) -> DataFrame:
    """``table_name, column_name`` and the value of every cell that is not null."""
    def cell(c: str, kind: str) -> Column:
        own = {"bigint": "whole", "double": "real"}.get(kind, "text")
        return F.struct(F.lit(c).alias("column_name"), *[
            (F.col(c) if v == own else F.lit(None)).cast(t).alias(v) for v, t in VALUE.items()])

    rows = df.select(F.lit(name).alias("table_name"), F.explode(F.array(*[cell(c, k) for c, k in df.dtypes])).alias("x"))
    return rows.select("table_name", "x.*").filter(" or ".join(f"{v} is not null" for v in VALUE))


@query(TWIN)
def report_tables(spark, d):
    """The tables of a report written together, read back by their manifest and profiled column by column."""
    folder = io_queries.scratch(spark)
    with shared_steps():  # the run's variants, its evidence and the liabilities are made once for all tables
        tables = {name: QUERIES[name](spark, d) for name in TABLES}
    results.write_report(tables, folder)
    parts = [cells(name, df) for name, df in results.read_report(spark, folder).items()]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("table_name", "column_name", *VALUE).agg(
        F.count("*").alias("n")).groupBy("table_name", "column_name").agg(
        F.sum("n").alias("n_values"), F.count("*").alias("n_distinct"))
