import zlib

import pytest
from pyspark.sql import functions as F

from proteoframe.llm import classifier, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    return queries.op1_quality_classifier(spark, SF).toPandas()


def test_held_out_accuracy(spark, result):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = result[result.held_out].merge(labels, on="doc_id")
    good, bad = both.score[both.quality == 1], both.score[both.quality == 0]
    auc = sum((g > bad).sum() + 0.5 * (g == bad).sum() for g in good) / len(good) / len(bad)
    assert auc > 0.93
    assert ((both.predicted == 1) == (both.quality == 1)).mean() > 0.93


def test_contract(spark, result):
    assert len(result) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(result.doc_id, result.held_out))
    assert result.score.between(0, 1).all() and ((result.score >= 0.7) == (result.predicted == 1)).all()


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    turned = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in classifier.scored(docs, labels).collect()}
    b = {r.doc_id: r.score for r in classifier.scored(docs, turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_edge_cases(spark, docs):
    rows = [(i, f"some prose number {i} that reads well.", "s") for i in range(20)]
    rows += [(None, "no id", "s"), (5, rows[5][1], "s"), (30, None, "s"), (31, "", "s"), (32, "word " * 30000, None)]
    df = docs(rows).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    got = classifier.scored(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    kept = classifier.keep_good(df, labels)
    assert kept.columns == df.columns
    none = labels.filter("doc_id = -1")
    assert all(r.score == 0.5 for r in classifier.scored(df, none).collect())
    assert classifier.scored(docs([]), labels).count() == 0
