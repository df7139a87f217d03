"""Explicit schemas of the JSON exchange formats."""

MUTATION = ("struct<position:int,wt:string,mut:string,source_step:string,score:double,"
            "metadata:string>")
CANDIDATE = (f"struct<sequence:string,name:string,candidate_id:string,parent_id:string,"
             f"structure_path:string,mutations:array<{MUTATION}>,scores:map<string,double>,"
             f"metadata:string>")
STEP = (f"step_name string, timestamp string, batch string, warnings array<string>, config_used string, "
        f"metadata string, candidates array<{CANDIDATE}>")
MODEL_SCORES = {
    "scores": "scores array<struct<id:string,e1_fitness:double,esm1v_pll:double,esmif1_score:double,score:double>>",
    "predictions": "predictions array<struct<position:int,wt:string,mut:string,ddg:double>>",
    "saturation_mutations": "saturation_mutations array<struct<position:int,wt:string,mut:string,gain:double>>",
}
