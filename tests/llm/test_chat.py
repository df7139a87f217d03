import hashlib

from pyspark.sql import functions as F

from proteoframe.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n", "<|user|>\n", "~", "~0", "~1", "<~1|", "<<SYS>>", "<", "[", "[INST", "<<|", "|>\n",
         "\\n $1 \\", "<|end|", "~~1<|", "ünï 🎉", "a\n\nb\n", "[[INST]]", ""]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def digests(spark, rows):
    got = chat.digests(chat.examples(spark.createDataFrame(rows, SCHEMA).withColumn("example", F.lit("clash"))))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()}


def test_round_trip(spark):
    rows = [(i, k, role, t) for i, role in enumerate(("user", "assistant", "system", "tool"))
            for k, t in enumerate(NASTY)]
    rows += [(10 + i, k, NASTY[(i + k) % len(NASTY)] if k % 3 else "assistant", NASTY[(i * 7 + k) % len(NASTY)])
             for i in range(30) for k in range(8)]
    assert digests(spark, rows) == want(rows)


def test_no_control_string_survives_inside(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.collect():
        assert not any(s in r.e for s in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<"))


def test_edge_cases(spark):
    rows = [(1, 0, None, None), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"), (2, None, "user", "first"), (None, 0, "user", "x"),
            (None, 1, "assistant", "y"), (3, 0, "user", "long " * 30000), (3, 1, "assistant", "z" * 100000)]
    assert digests(spark, rows) == want(rows)
    assert digests(spark, []) == {}


def test_examples(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A1"), (1, 3, "user", "V"), (1, 4, "assistant", "<s>A2"),
            (1, 5, "user", "W")]
    got = chat.examples(spark.createDataFrame(rows, SCHEMA)).orderBy("example").collect()
    texts = [r.text for r in got]
    assert len(got) == 3 and all(texts[i + 1].startswith(texts[i]) for i in range(2))
    assert texts[0] == "<|system|>\nS<|end|>\n<|user|>\nU<|end|>\n<|assistant|>\nA1<|end|>\n"
    assert [r.text[r.loss_start:r.loss_end] if r.loss_start is not None else None for r in got] == ["A1", "<~1s>A2", None]
    assert [r.last for r in got] == [False, False, True]


def test_query_holds_the_added_conversation(spark):
    got = queries.op7_chat_format(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (2, len(said), sha(said))
    assert got.turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")


def test_plan_is_native(spark):
    df = chat.digests(chat.examples(spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
