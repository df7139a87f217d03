import re
from collections import Counter

from pyspark.sql import functions as F

from proteoframe.llm import rules
from proteoframe.llm.textstats import rule_counts

PROSE = "The quick fox met a slow hound near the old mill today. It went home before rain fell on fields again.\n"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def test_counts_equal_brute_force():
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e f", "x\nx\ny\n x\n\n\nx", "é ü \x1c z|<>#",
             "a a a a a a a", "lines\r\nlines\r\n", "w " * 5000]
    for t in texts:
        assert rule_counts(t)[:5] == brute(t), t


def test_verdicts_and_edge_cases(spark, docs):
    good = [(i, "".join(f"{w} " if i % 7 else f"{w}{i} " for w in PROSE.split()), "s") for i in range(60)]
    bad = [(100 + i, " ".join(f"word{i}x{j}###" for j in range(40)), "s") for i in range(12)]
    odd = [(200, None, None), (201, "", "s"), (None, PROSE, "s"), (1, good[1][1], "s"), (202, PROSE * 3000, "s")]
    df = docs(good + bad + odd).withColumn("kept", F.lit("clash")).withColumn("_row", F.lit(1))
    got = {(r.doc_id, r.kept) for r in rules.judged(df).select("doc_id", "kept").collect()}
    assert {(i, True) for i in range(60)} <= got
    assert {(100 + i, False) for i in range(12)} | {(200, False), (201, False), (202, False), (None, True)} <= got
    kept = rules.keep_good(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted([*range(60), 1]) and ids.count(None) == 1


def test_empty_table(spark, docs):
    assert rules.judged(docs([])).count() == 0
    assert rules.keep_good(docs([])).count() == 0


def test_em_weighs_a_noisy_rule_less():
    import numpy as np
    rng = np.random.default_rng(1)
    n = 20_000
    good = rng.random(n) < 0.85
    votes = np.full((n, len(rules.RULES)), rules.GOOD)
    for r in range(3):
        votes[:, r] = np.where(rng.random(n) < 0.95, good, ~good)
    votes[:, 3] = np.where(rng.random(n) < 0.55, good, ~good)
    votes[:, 4:] = rules.ABSTAIN
    patterns, weights = np.unique(votes @ 3 ** np.arange(len(rules.RULES)), return_counts=True)
    model = rules.fit(patterns, weights.astype(float))
    assert abs(model["prior"] - 0.85) < 0.03
    weight = np.log(model["table"][:, 1, 1] / model["table"][:, 0, 1])
    assert weight[3] < 0.5 < 1.5 < weight[:3].min()
    assert (rules.posterior(model, votes @ 3 ** np.arange(len(rules.RULES))) >= 0.5).astype(bool)[good].mean() > 0.97


def test_labels_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = rules.judged(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed")
    right = both.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97
