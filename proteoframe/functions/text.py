"""String column expressions over residue strings."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from proteoframe.functions import constants as K


def count_of(text: Column, letters: str) -> Column:
    """How many characters of ``text`` are in ``letters``."""
    rest = text
    for a in letters:
        rest = F.replace(rest, F.lit(a), F.lit(""))
    return F.length(text) - F.length(rest)


def charge_marks(seq: Column) -> Column:
    """The sequence with every charged residue written as ``+``."""
    return F.regexp_replace(seq, f"[{K.CHARGED}]", "+")


def letter_mask(letters: list[Column]) -> Column:
    """One integer in which each of the given upper-case letters sets its bit.

    ``bit_count`` of it is the number of different letters; nothing is split.
    """
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(c) - 65) for c in letters]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def lookup(key: Column, table: dict, default=None) -> Column:
    """Value of a small constant table as one CASE expression."""
    branches = iter(table.items())
    k, v = next(branches)
    expr = F.when(key == k, F.lit(v))
    for k, v in branches:
        expr = expr.when(key == k, F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))


def map_of_present(entries: list[tuple[Column, Column]]) -> Column:
    """A map of the entries whose value is not null, as one choice among the ready-made maps.

    It has no lambda, which would take the rows out of generated code; meant for a handful of entries.
    """
    def choose(rest: list[tuple[Column, Column]], taken: list[Column]) -> Column:
        if not rest:
            return F.create_map(*taken) if taken else F.create_map().cast("map<string,double>")
        (key, value), *others = rest
        return F.when(value.isNotNull(), choose(others, [*taken, key, value])).otherwise(choose(others, taken))

    return choose(entries, [])


def mutation_label(wt: Column, position: Column, mut: Column) -> Column:
    return F.concat(wt, position.cast("string"), mut)


def labels(muts: Column) -> Column:
    """Labels of an array of mutation structs."""
    return F.transform(muts, lambda m: mutation_label(m["wt"], m["position"], m["mut"]))


def num_mutations(muts: Column) -> Column:
    return F.when(muts.isNull(), F.lit(0)).otherwise(F.size(muts))


def replace_residue(seq: Column, position: Column, mut: Column) -> Column:
    return F.overlay(seq, mut, position, F.lit(1))


def residue_at(seq: Column, position: Column) -> Column:
    return seq.substr(position.cast("int"), F.lit(1))


def mutations_valid(seq: Column, muts: Column) -> Column:
    """Every position in range, every wild type right, no position twice."""
    in_place = F.forall(
        muts,
        lambda m: (m["position"] >= 1)
        & (m["position"] <= F.length(seq))
        & (residue_at(seq, m["position"]) == m["wt"]),
    )
    distinct = F.size(F.array_distinct(F.transform(muts, lambda m: m["position"]))) == F.size(muts)
    return in_place & distinct


def apply_all(seq: Column, muts: Column) -> Column:
    """The sequence with every mutation of a valid array written in."""
    return F.aggregate(muts, seq, lambda s, m: replace_residue(s, m["position"], m["mut"]))


def differences(a: Column, b: Column) -> Column:
    """Mutations that turn ``a`` into ``b`` over their common length."""
    n = F.least(F.length(a), F.length(b))
    pairs = F.transform(
        F.arrays_zip(F.split(a, "").alias("wt"), F.split(b, "").alias("mut")),
        lambda p, i: F.struct((i + 1).alias("position"), p["wt"].alias("wt"), p["mut"].alias("mut")),
    )
    return F.filter(pairs, lambda p: (p["position"] <= n) & (p["wt"] != p["mut"]))


def hamming(a: Column, b: Column) -> Column:
    """Differing positions over the common length.

    ``levenshtein`` is no substitute (it shifts), so letters are compared one by
    one; a null beyond the shorter sequence counts as equal.
    """
    unequal = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x != y, F.lit(False)).cast("int"))
    n = F.least(F.length(a), F.length(b))
    return F.aggregate(F.slice(unequal, F.lit(1), F.greatest(n, F.lit(0))), F.lit(0), lambda s, u: s + u)


def last_of_each(entries: Column, key: str) -> Column:
    """Of a sorted array of structs the last entry of every ``key``."""
    return F.filter(entries, lambda e, i: ~F.coalesce(F.get(entries, i + 1)[key] == e[key], F.lit(False)))


def with_kept(seq: Column, kept: Column, at, between) -> Column:
    """The sequence with ``at`` applied to the residues at ``kept`` positions and ``between`` to the rest.

    ``kept`` is an array of positions, in any order and also out of range. The
    sequence is cut once at each of them, in time linear in both lengths.
    """
    raw = seq.cast("binary")
    inside = F.array_sort(F.array_distinct(F.filter(
        F.transform(kept, lambda p: p.cast("int")), lambda p: (p >= 1) & (p <= F.length(seq)))))
    cuts = F.concat(F.array(F.lit(0)), inside)

    def piece(p: Column, i: Column) -> Column:
        following = F.coalesce(F.get(cuts, i + 1), F.length(seq) + 1)
        own = F.when(p > 0, at(raw.substr(p, F.lit(1)).cast("string"))).otherwise("")
        return F.concat(own, between(raw.substr(p + 1, following - p - 1).cast("string")))

    return F.array_join(F.transform(cuts, piece), "")


def context(seq_window: Column, before: int, after: int) -> Column:
    """Bracket the centre of a padded window and drop the padding."""
    left = F.replace(seq_window.substr(1, before), F.lit(K.GAP), F.lit(""))
    right = F.replace(seq_window.substr(before + 2, after), F.lit(K.GAP), F.lit(""))
    return F.concat(left, F.lit("["), seq_window.substr(before + 1, 1), F.lit("]"), right)


def entropy(window: Column, width: int) -> Column:
    """Shannon entropy in bits of a fixed-width residue window.

    A fold over the letters present keeps the generated method small enough
    for the JVM to compile it.
    """
    shares = F.transform(
        F.array_distinct(F.split(window, "")),
        lambda a: (width - F.length(F.replace(window, a, F.lit("")))) / F.lit(float(width)))
    return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def max_distinct(width: int, limit: float) -> int:
    """Most different letters a window can hold with entropy below ``limit``.

    For k letters the entropy is least when one letter fills all but k-1 places.
    """
    k = 1
    while k < width:
        rare, common = k / width, (width - k) / width
        least = -rare * math.log2(1 / width) - common * math.log2(common)
        if least >= limit:
            break
        k += 1
    return k


def band(value: Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first lower bound the value reaches (cuts descend)."""
    expr = F.when(value >= cuts[0][0], cuts[0][1])
    for bound, label in cuts[1:]:
        expr = expr.when(value >= bound, label)
    return expr.otherwise(otherwise)
