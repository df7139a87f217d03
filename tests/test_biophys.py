"""Metrics of long sequences, where sums of doubles would show their rounding."""

import random
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from proteoframe.functions import constants as K
from proteoframe.operators import biophys
from proteoframe.session import tidy


#: Compositions whose mean hydropathy ends in a five behind the sixth decimal, and that mean rounded.
TIES = [
    ("A15 C10 D8 E5 F15 G13 H15 I12 K15 L14 M18 N9 P12 Q12 R22 S43 T40 V16 W11 Y15", -0.431563),
    ("A9 C10 D13 E14 F15 G13 H12 I13 K11 L9 M14 N19 P20 Q13 R10 S14 T73 V11 W9 Y18", -0.672188),
    ("A14 C18 D10 E6 F11 G15 H16 I10 K13 L12 M18 N17 P10 Q9 R18 S17 T74 V14 W10 Y8", -0.475313),
    ("A17 C16 D11 E17 F15 G16 H14 I10 K8 L14 M11 N10 P7 Q15 R13 S15 T68 V13 W17 Y13", -0.447188),
]


def test_ties_of_gravy_are_kept(spark, seqs):
    texts = ["".join(part[0] * int(part[1:]) for part in counts.split()) for counts, _ in TIES]
    got = {r.pid: r.gravy for r in tidy(biophys.sequence_metrics(seqs(*texts))).collect()}
    assert [got[i] for i in range(1, len(TIES) + 1)] == [want for _, want in TIES]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT unnest(range(1, len($t) + 1)) AS doc_id, unnest($t) AS text", {"t": texts})
    rows = con.execute(entry.oracle_sql()["sequence_metrics"]).df().sort_values("pid")
    assert rows["gravy"].tolist() == [want for _, want in TIES]


@pytest.mark.parametrize("seed", range(2))
def test_sql_adds_masses_exactly(seed):
    rng = random.Random(seed)
    text = "".join(rng.choices(K.ALPHABET, k=400_000))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT 1::BIGINT AS doc_id, ? AS text", [text])
    row = con.execute(entry.oracle_sql()["sequence_metrics"]).df().iloc[0]
    mass = sum(Decimal(str(K.RESIDUE_MASS[a])) for a in text) - Decimal("18.015") * (len(text) - 1)
    assert row["mw"] == float(mass)
