"""Tables of a report share ranked rows; evidence of known sources needs one exchange."""

from pyspark.sql import functions as F

from proteoframe.operators import evidence as E
from proteoframe.operators import report as R
from proteoframe.plans import report_queries, run_queries
from proteoframe.session import shared_steps

SF = "/root/testdata/sf0.001"
MUTS = [
    (1, 3, "C", "S", "cysteine_scan", 1, 0.5), (1, 3, "C", "S", "ddg_step", 7, None), (1, 3, "C", "S", "ddg_step", 6, -2.0),
    (1, 4, "M", "L", "motif_scan", 2, -1.0), (1, 4, "M", "L", None, 9, 4.0), (2, 3, "C", "S", "motif_scan", 2, None)]


def test_evidence_of_known_sources_equals_the_plain_way(spark):
    muts = spark.createDataFrame(MUTS, "pid long, position int, wt string, mut string, source_step string, step_no long, score double")
    steps = ["ddg_step", "cysteine_scan", "motif_scan", "unused"]
    plain, known = E.consolidate_evidence(muts), E.consolidate_evidence(muts, steps)
    assert known.select(plain.columns).dtypes == plain.dtypes
    assert sorted(map(repr, known.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "collect_list" not in plan


def test_first_rows_come_from_the_library_ranking(spark):
    with shared_steps():
        tables = [report_queries.QUERIES[n](spark, SF) for n in ("variant_library", "candidate_table", "top_recommendations")]
        first = run_queries._first_ranked(spark, SF)
    for df in tables[1:]:
        assert sorted(df.inputFiles()) == sorted(first.inputFiles())
    assert first.groupBy("pid").count().filter(F.col("count") > R.LIBRARY_TOP).count() == 0
    for name, df in zip(("candidate_table", "top_recommendations"), tables[1:]):
        alone = report_queries.QUERIES[name](spark, SF)
        assert df.exceptAll(alone).isEmpty() and alone.exceptAll(df).isEmpty()


def test_cells_keep_numbers(spark):
    df = spark.createDataFrame([(1, 0.5, "a", True, None), (1, 1.5, None, False, None)], "n long, x double, s string, b boolean, e double")
    cells = report_queries.cells("t", df)
    assert {(r.column_name, r.whole, r.real, r.text) for r in cells.collect()} == {
        ("n", 1, None, None), ("x", None, 0.5, None), ("x", None, 1.5, None), ("s", None, None, "a"),
        ("b", None, None, "true"), ("b", None, None, "false")}
