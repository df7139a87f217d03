import hashlib
import re

from pyspark.sql import functions as F

from proteoframe.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights=(1, 2, 3), cap=3):
    """Clamp and share out again until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > cap * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


ROWS = ([(i, "w " * (i % 17 + 1), "a") for i in range(40)] + [(100 + i, "x y z", "b") for i in range(5)]
        + [(200 + i, "long " * 300, "c") for i in range(6)] + [(300, "one two", "é"), (301, "solo", None), (302, "pair of", None)]
        + [(400, None, "a"), (401, "", "b"), (402, None, "nothing"), (None, "no id here", "a"), (7, "w " * 8, "a"), (7, "w " * 8, "a")])


def sizes_of(rows):
    out = {}
    for _, t, s in rows:
        out[s] = out.get(s, 0) + len(WORD.findall(t or ""))
    return out


def test_targets_equal_repeated_clamping(docs):
    got = {}
    for r in mixing.mixed(docs(ROWS).withColumn("target", F.lit("clash"))).join(
            docs(ROWS).select("doc_id", "source"), "doc_id").collect():
        got[r.source] = r.target
    want = water_fill(sizes_of(ROWS))
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in want if s in got)
    assert abs(sum(want.values()) - sum(sizes_of(ROWS).values())) < 1e-6


def test_taken_words(docs):
    df = docs(ROWS)
    got = mixing.mixed(df).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 2
    again = sorted(map(str, mixing.mixed(df.repartition(7)).collect()))
    assert again == sorted(map(str, got))


def test_the_fractional_pass_follows_the_key_order(docs):
    rows = [(i, "w " * (i % 5 + 1), "only" if i % 2 else "other") for i in range(60)]
    got = {r.doc_id: r for r in mixing.mixed(docs(rows)).collect()}
    want = water_fill(sizes_of(rows))
    for source in ("only", "other"):
        size, target = sizes_of(rows)[source], want[source]
        whole, left = int(target // size), round(target) - int(target // size) * size
        for i in sorted((i for i, _, s in rows if s == source), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()):
            part = min(left, got[i].size)
            assert got[i].taken == whole * got[i].size + part
            left -= part


def test_mix_repeats_whole_rows(docs):
    df = docs([r for r in ROWS if r[0] != 7]).withColumn("whole", F.lit("clash"))
    want = {r.doc_id: r for r in mixing.mixed(df).collect()}
    out = mixing.mix(df)
    assert out.columns == df.columns
    texts, got = {r[0]: r[1] for r in ROWS}, {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        assert r.text == texts[r.doc_id]
    missed = {}
    for i, r in want.items():
        assert abs(got.get(i, 0) * r.size - r.taken) <= r.size / 2
        if got.get(i, 0) * r.size != r.taken:
            missed[r.source] = missed.get(r.source, 0) + 1
    assert all(n == 1 for n in missed.values())


def test_rows_of_one_id_are_told_apart_by_their_text(docs):
    rows = [(None, f"word{i} " * 10, "hot") for i in range(50)] + [(1, "w " * 100, "b")]
    out = mixing.mix(docs(rows)).filter("source = 'hot'")
    target = mixing.mixed(docs(rows)).filter("source = 'hot'").first().target
    assert abs(sum(len(r.text.split()) for r in out.collect()) - target) <= 5


def test_empty(docs):
    assert mixing.mixed(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0
    assert [r.taken for r in mixing.mixed(docs([(1, None, None), (2, "", "a")])).collect()] == [0, 0]
