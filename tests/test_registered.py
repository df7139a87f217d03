"""Registered queries against their SQL twins on the smallest tables.

A cross-section by default; all of them with PROTEOFRAME_ALL=1.
"""

import os

import pytest
from harness import connect, difference

import __spark_entry__ as entry
from proteoframe.plans import registry

SF = "/root/testdata/sf0.001"
SOME = (
    "cysteine_scan", "motif_variants", "complexity_flags", "sequence_metrics", "aggregation_propensity",
    "apply_mutations", "motif_contigs", "consensus_mutations", "pssm_table", "homologs_deduplicated",
    "kmer_homologs", "composite_score", "ranked_candidates", "quality_filter", "score_correlation",
    "combine_variants", "multi_evidence", "tier_analysis", "variant_library", "disulfide_variants",
    "cavity_variants", "surface_variants", "superposition_rmsd", "saturation_scan", "wildtype_marginal",
    "liability_table", "diversified", "fasta_round_trip", "json_results_dir", "cif_round_trip",
)
NAMES = sorted(registry.queries()) if os.environ.get("PROTEOFRAME_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert difference(got, want) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
