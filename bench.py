"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "motif_totals", "cysteine_scan", "complexity_totals", "sequence_metrics",
    "aggregation_propensity", "apply_mutations", "consensus_mutations", "pssm_mutations",
    "kmer_homologs", "composite_score", "ranked_candidates", "quality_filter",
    "combine_variants", "consolidated_evidence", "variant_library", "score_correlation",
    "disulfide_pairs", "atom_sasa", "superposition_rmsd", "wildtype_marginal",
    "liability_table", "diversified",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("proteoframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("proteoframe.scan.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from proteoframe.plans import registry

    queries = registry.queries()
    wanted = sys.argv[1:] or HEADLINE
    queries["score_stats"](spark, sf_dir).collect()  # starts the JVM's code generator
    times = {}
    for name in wanted:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
