"""Alphabets, rule tables, property scales, default weights.

Every table here has fewer than fifty entries, so using one as a literal
expression never grows with the data.
"""

# ---- fixed values (must equal the published scales and rule sets) ----

ALPHABET = "ACDEFGHIKLMNPQRSTVWY"
GAP = "-"
CHARGED = "DEKRH"
HYDROPHOBIC = "ILMFVW"

# dipeptide -> risk; the first residue is replaced (N -> Q, D -> E)
DEAMIDATION_RULES = {"NG": 1.0, "NS": 0.7, "NH": 0.5, "NA": 0.3, "NT": 0.3, "DG": 0.6}
# dipeptide -> risk; the second residue is replaced by Q
DIBASIC_RULES = {"RR": 0.8, "KR": 0.7, "RK": 0.6, "KK": 0.4}

# average residue masses in dalton
RESIDUE_MASS = {
    "A": 89.09, "R": 174.20, "N": 132.12, "D": 133.10, "C": 121.16,
    "E": 147.13, "Q": 146.15, "G": 75.03, "H": 155.16, "I": 131.17,
    "L": 131.17, "K": 146.19, "M": 149.21, "F": 165.19, "P": 115.13,
    "S": 105.09, "T": 119.12, "W": 204.23, "Y": 181.19, "V": 117.15,
}
UNKNOWN_MASS = 128.0
WATER_MASS = 18.015

# Kyte-Doolittle hydropathy
HYDROPATHY = {
    "A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5,
    "E": -3.5, "Q": -3.5, "G": -0.4, "H": -3.2, "I": 4.5,
    "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6,
    "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2,
}

# pKa of ionisable side chains and of the termini
PKA_ACID = {"D": 3.65, "E": 4.25, "C": 8.18, "Y": 10.46}
PKA_BASE = {"H": 6.00, "K": 10.53, "R": 12.48}
PKA_N_TERMINUS = 9.69
PKA_C_TERMINUS = 2.34

# dipeptide instability weights that differ from the default of 1.0
INSTABILITY_WEIGHTS = {
    "WM": 24.68, "WG": -9.37, "GG": -7.49, "GA": -7.49, "GE": -6.54,
    "GK": -7.49, "CW": 24.68, "CM": 33.6, "DF": -6.54, "LP": 20.26,
}

# extended-tripeptide maximum accessible surface, square angstrom
MAX_SURFACE = {
    "A": 129, "R": 274, "N": 195, "D": 193, "C": 167,
    "Q": 225, "E": 223, "G": 104, "H": 224, "I": 197,
    "L": 201, "K": 236, "M": 224, "F": 240, "P": 159,
    "S": 155, "T": 172, "W": 285, "Y": 263, "V": 174,
}

# substitutions in preference order
CAVITY_SUBSTITUTIONS = {"G": "A", "A": "VL", "V": "IL", "S": "TV", "T": "VI"}
SURFACE_SUBSTITUTIONS = {"I": "TK", "L": "KQ", "M": "KQ", "F": "YR", "V": "TD", "W": "RY"}

DEFAULT_WEIGHTS = {
    "e1_fitness": 0.25, "esm1v_delta": 0.20, "esmif1_delta": 0.15,
    "mpnn_score": 0.10, "consensus_score": 0.10, "pssm_delta": 0.10,
    "ddg": 0.05, "cavity_burial": 0.025, "surface_sap": 0.025,
}
LOWER_IS_BETTER = ("ddg", "surface_sap")

# first present key decides the ranking score of a variant
SCORE_PRIORITY = (
    "ddg", "pssm_log_odds", "consensus_conservation", "mpnn_score",
    "cavity_burial", "disulfide_energy_estimate", "surface_sap",
    "motif_risk_fixed", "cys_risk", "e1_fitness", "esm1v_delta", "esmif1_delta",
)

STEP_TIERS = {
    "cysteine_scan": 1, "motif_scan": 1, "sequence_complexity": 1,
    "find_homologs": 2, "consensus_design": 2, "pssm_analysis": 2,
    "predict_structure": 3, "disulfide_design": 3, "cavity_fill": 3,
    "surface_patch": 3, "stability_ddg": 3,
    "rfdiffusion_diversify": 4, "proteinmpnn_design": 4,
    "design_validate": 4, "combine_variants": 4,
    "esm1v_score": 5, "e1_score": 5, "esmif1_score": 5,
    "motif_scaffold": 6,
}
SCORING_TIERS = (5, 6)

# score keys that never become report columns
LIBRARY_SKIP_KEYS = (
    "n_mutations", "combo_sum", "motif_risk_total", "motif_count",
    "complexity_issues", "complexity_risk_total",
)
STEP_SKIP_KEYS = LIBRARY_SKIP_KEYS + ("composite_score", "combo_mean")

# van der Waals radii, angstrom
ATOM_RADII = {"H": 1.2, "C": 1.7, "N": 1.55, "O": 1.52, "S": 1.8}
DEFAULT_RADIUS = 1.7
# ---- end of fixed values ----
