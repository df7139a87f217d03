"""The wild type of an alignment is met by its residues."""

from proteoframe.operators import msa as M


def test_wild_type_is_met_by_residues(spark):
    rows = [("a", 0, "AC-"), ("a", 1, "A-D"), ("a", 2, "AD-"), ("b", 0, "KK-"), ("b", 1, "K--")]
    msa = spark.createDataFrame(rows, "pid string, rec_idx long, aligned string")
    wild = spark.createDataFrame([("a", "AD"), ("b", "ABSENT"), ("c", "K")], "pid string, sequence string")
    out = M.wt_record(msa, wild)
    assert sorted(map(tuple, out.collect())) == [("a", 1, "A-D"), ("b", 0, "KK-")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "_wt" in plan.split("Join Inner")[1].splitlines()[0]
