"""The step that all variant tables share: scores in columns, weighed once."""

from pyspark.sql import functions as F

from proteoframe.functions import text as S
from proteoframe.operators import scoring
from proteoframe.plans import run_queries
from proteoframe.session import shared, shared_steps


def test_entries_score_as_their_map(spark):
    rows = [(i, [None, 0.1 * i, -2.0][i % 3], [1.0, None][i % 2], ["ddg", "cys_risk", "surface_sap"][i % 3], 0.3 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "candidate_id int, a double, b double, k string, v double")
    entries = [(F.lit("e1_fitness"), F.col("a")), (F.lit("esm1v_delta"), F.col("b")), (F.col("k"), F.col("v"))]
    wide = df.withColumn("scores", S.map_of_present(entries))
    assert all(None not in r.scores.values() for r in wide.collect())
    by_map = {r.candidate_id: r.composite_score for r in scoring.composite_in_row(wide).collect()}
    by_entry = {r.candidate_id: r.composite_score for r in scoring.composite_in_row(df, entries=entries).collect()}
    assert by_entry == by_map and len(set(by_map.values())) > 10


def test_a_composite_score_makes_no_map(spark):
    """The map used to be made again for every weight of every row."""
    plan = run_queries.variants(spark, "/root/testdata/sf0.001").select("pid", "composite_score")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in text and "Aggregate" not in text


def test_steps_of_one_result_are_made_once(spark):
    made = []

    @shared
    def step(spark, d):
        made.append(d)
        return spark.range(3)

    with shared_steps():
        assert [step(spark, d).count() for d in ("a", "a", "b")] == [3, 3, 3] and made == ["a", "b"]
    step(spark, "a")
    assert made == ["a", "b", "a"]
