"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proteoframe.llm import (
    chat, classifier, fixity, langid, lexical, licenses, mixing, nearest, packing, prefixtrie, rules, simhash, sql, wavelet)
from proteoframe.llm.base import running_sum, store, word_count

#: Pages of one archive file.
FILE_PAGES = 1000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return classifier.scored(_table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.nearest(vectors.filter("vec_id % 50 = 0"), vectors, k=5)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only lengths decide, so texts stay behind.
    sizes = _table(spark, sf_dir, "documents").select("doc_id", word_count(F.col("text")).alias("size"))
    return packing.packed(sizes, length=F.col("size")).drop("size")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.known_licenses(spark))


def op6_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as archive files of FILE_PAGES records; in the second replica every 97th page has a byte
    changed and every 211th is lost."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    record = fixity.warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    sized = pages.select("page_id", F.expr(f"page_id div {FILE_PAGES}").alias("file"),
                         F.expr("page_id div 100").alias("_piece"), F.octet_length(record).alias("size"))
    at = store(running_sum(sized, ["file"], "_piece", ["page_id"], "size", "offset").select("page_id", "file", "offset"))
    html = F.concat(F.lit("?"), F.expr("substring(html, 2)"))
    damaged = fixity.warc_record(F.col("url"), F.col("page_id"),
                                 F.when(F.col("page_id") % 97 == 5, html).otherwise(F.col("html")))
    first, second = (fixity.digested(df.select("page_id", body.alias("payload")).withColumn("file", F.lit(0)), "file", "page_id")
                     .withColumnRenamed("offset", "page_id").drop("file").join(at, "page_id").drop("page_id")
                     for df, body in ((pages, record), (pages.filter("page_id % 211 != 7"), damaged)))
    return fixity.audit(first, second).select(
        F.col("file").cast("long").alias("file"), "offset", "range", "kind", "length_a", "length_b",
        "digest_a", "digest_b")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.examples(turns))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return wavelet.documents(store(wavelet.shards(docs, public_tokenizers.path("word_bpe_49k.json"))))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(docs).select(
        "doc_id", *(F.col(f"_counts.{c}").alias(c) for c in
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "base_failed", "kept", "posterior")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.ranked(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"), k=50)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefixtrie.trie(prefixtrie.with_shared_starts(prefixtrie.paths(turns)))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_quality_classifier, op2_mixing, op3_nearest, op4_packing, op5_license_scan, op6_fixity_audit,
           op7_chat_format, op8_token_shards, op9_simhash, op10_quality_rules, op11_lexical_search,
           op12_language_id, op13_prefix_trie, pipeline)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.SQL)
