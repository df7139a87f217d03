import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proteoframe.llm import queries, wavelet
from proteoframe.llm.base import store

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,planes", [(0, 16), (1, 16), (7, 3), (5000, 9), (200_000, 16), (3000, 20)])
def test_shard_answers(n, planes, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1024)
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.4, n) % (1 << planes)).astype(np.uint16 if planes <= 16 else np.uint32)
    shard = wavelet.Shard(wavelet.write_shard(ids, np.array([0]), [5], planes))
    assert (shard.ids() == ids).all() and shard.n == n and shard.docs == [5]
    for i in rng.integers(0, n, 40) if n else []:
        assert shard.access(int(i)) == ids[i]
    for token in {*ids[:10].tolist(), 0, (1 << planes) - 1, 1 << planes}:
        at = np.flatnonzero(ids == token)
        assert shard.count(token) == len(at)
        for i in (0, n // 3, n):
            assert shard.rank(token, i) == (ids[:i] == token).sum()
        for k in {0, len(at) // 2, len(at) - 1} if len(at) else ():
            assert shard.select(token, k) == at[k]
        with pytest.raises(IndexError):
            shard.select(token, len(at))
    with pytest.raises(IndexError):
        shard.access(n)


def expected(rows):
    tokenizer = Tokenizer.from_file(FILE)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["don't we'll  it's here", "ＡＢＣ é é ǅ ΑΣ ΑΣ. İ", "<|endoftext|>x <|startoftext|>", "a b\x85c\x1cd　e", "12 345 ½ ²", "!!! ... --",
       "日本語 テスト 한국어", "﻿bom ​zero", "a\tb\nc\x0bd\x0ce\rf", "🎉👩‍👩‍👧 x", " ", "'s 't ' s"]


def rows_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = wavelet.documents(store(wavelet.shards(df, FILE, **options))).collect()
    return sorted(map(tuple, got), key=lambda r: r[1])


def test_ids_equal_whole_text_encoding(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, ""), (None, "no id"), (52, "long words " * 20000), (7, ODD[3]), (7, ODD[7])]
    assert rows_of(spark, rows) == expected(rows)
    assert rows_of(spark, rows, shard_ids=5) == expected(rows)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_WORDS", 3)
    words = wavelet.WordIds(lambda ws: [[len(w)] for w in ws], "<u2")
    for batch in ([[b"a", b"bb"]], [[b"ccc", b"bb", b"e"]], [[b"dddd", b"a"]], [[b"a", b"zzzzzz"]], [[b"bb"]]):
        words.learn(batch)
        assert all(words[w] == np.array([len(w)], "<u2").tobytes() for w in batch[0])
        assert len(words) <= 6 and len(words.old) <= 6


def test_words_encoded_together_equal_words_encoded_alone():
    tokenizer = Tokenizer.from_file(FILE)
    texts = ["Straße, naïve; ÀÉÎ ŉa Ǆx ªº İstanbul Ωmega don't it's 1a a1 x.y ... !? I'm Über. ﬁne", *ODD]
    parts = [t.encode().split() for t in texts for _ in range(3)]
    words = wavelet.word_ids(FILE, "<u2")
    words.learn(parts)
    for word in set().union(*parts):
        assert np.frombuffer(words[word], "<u2").tolist() == tokenizer.encode(word.decode(), add_special_tokens=False).ids, word


def test_query_equals_whole_text_encoding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op8_token_shards(spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs])


def test_empty(spark):
    assert rows_of(spark, []) == []
