"""Language identification by cross-parsing.

For each language the model is a suffix automaton of a sample of its labelled
text. A text is parsed against each automaton: from where the last phrase ended,
the longest string that occurs anywhere in the sample is the next phrase; a
letter that the sample lacks is a phrase of its own. A phrase costs as many bits
as it takes to point into the largest sample, so phrases times these bits, per
letter, estimate the cross entropy (Ziv and Merhav). The language that needs the
fewest phrases for a text wins; a language of which little is known needs more.

Some megabytes of texts are parsed side by side, one letter of each at a time: where an
automaton goes from each state by each letter stands in an array, so a step of all texts under all
languages is a lookup of numpy. The few longest of these texts, and languages with so many
letters that the array would be large, are parsed letter by letter in Python.

The sample is bounded: at most ``PIECES`` pieces of ``PIECE_CHARS`` characters of a
language, at most ``MODEL_CHARS`` characters of all languages together, which they
share alike, and the ``LANGUAGES`` languages with the most texts. Pieces come from
different texts, picked by a hash of the text, so copies count once and no id
enters. A piece starts where the same hash says. Every text is predicted as a
whole.

Texts are compared in lower case, NFC, with everything but letters folded to one
blank. A text that is null or has no letter gets ``und`` with score 0. The score
is the posterior of the winner if a text costs as many bits under a language as
its phrases do. Ties go to the first language by code point. Rows without a label
are predicted but not learned from; if nothing can be learned, every text gets
``und``. Rows that repeat an id or a text get one row each; a null id is kept and
never held out. Extra columns are not read.
"""

from __future__ import annotations

import gc
import math
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proteoframe.llm.base import small_batches, store

#: Bounds of the sample: pieces of a language, their length, length of all together, languages.
PIECES, PIECE_CHARS, MODEL_CHARS, LANGUAGES = 160, 500, 400_000, 400
#: Rows that are read for each piece that is wanted.
SPARE = 4
UNKNOWN = "und"
#: Stands between pieces; no folded text holds it.
BREAK = "\n"
#: Letters that give a first guess, and bits behind the winner that leave no share of the score.
GUESS_CHARS, LOST_BITS = 200, 64
#: Bytes of texts that are parsed side by side, and how many of them, the longest, are parsed alone.
TOGETHER, ALONE = 4 << 20, 8
#: Cells of the arrays of all automata, and columns that are looked up at a time.
CELLS, LOOKUPS = 64_000_000, 1_000_000

_OTHER = re.compile(r"[\W\d_]+")


def folded(text: str | None) -> str:
    """Lower-case letters with single blanks; empty if there is no letter."""
    if not text:
        return ""
    low = _OTHER.sub(" ", unicodedata.normalize("NFC", text.lower())).strip()
    return low if any(map(str.isalpha, low)) else ""


def numbered_moves(text: str) -> list[dict]:
    """The moves of the suffix automaton of ``text``: by state, from a letter to the number of the next state."""
    moves: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and ch not in moves[at]:
            moves[at][ch] = new
            at = link[at]
        if at >= 0:
            target = moves[at][ch]
            if length[target] > length[at] + 1:
                copy = len(moves)
                moves.append(moves[target].copy())
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(ch) == target:
                    moves[at][ch] = copy
                    at = link[at]
                link[target] = copy
                target = copy
            link[new] = target
        last = new
    return moves


def linked(moves: list[dict]) -> dict:
    """The start state; a state is a dict from a letter to the next state."""
    for state in moves:
        for ch, target in state.items():
            state[ch] = moves[target]
    return moves[0]


def suffix_automaton(text: str) -> dict:
    """The start state of the automaton of ``text``.

    A string occurs in ``text`` just if its letters lead from state to state.
    """
    return linked(numbered_moves(text))


def phrases(text: str, start: dict, most: float = math.inf) -> int:
    """Phrases of ``text`` by longest matches; stops when there are more than ``most``."""
    if not text:
        return 0
    # The phrase that is open, perhaps still empty, is counted.
    count, state = 1, start
    for ch in text:
        after = state.get(ch)
        if after is None:
            if state is not start:
                count += 1
                after = start.get(ch)
            if after is None:
                # A letter the sample lacks.
                count += 1
                after = start
            if count > most:
                return count
        state = after
    return count - (state is start)


class Tables:
    """Automata as arrays, for texts that are parsed side by side.

    A language has a row of cells for each state: one for each letter of its sample, and a last one for
    all other letters. ``follows`` tells where the row of the next state begins, ``costs`` how many
    phrases begin there: one where no move leads on, since the letter starts a phrase; after a letter
    that the sample lacks also the one that is open, unless it is empty.
    """

    def __init__(self) -> None:
        self.languages: list[int] = []
        self.letters: list[list[str]] = []
        self.starts: list[int] = []
        self.size = 0
        self._follows: list[np.ndarray] = []
        self._costs: list[np.ndarray] = []

    def add(self, language: int, moves: list[dict]) -> None:
        """Take in the moves of a language, unless the arrays would be too large."""
        letters = sorted(moves[0])
        width = len(letters) + 1
        if self.size + len(moves) * width > CELLS:
            return
        column = {ch: i for i, ch in enumerate(letters)}
        follows = np.tile(np.array([moves[0][ch] for ch in letters] + [0], dtype=np.int32), (len(moves), 1))
        costs = np.ones(follows.shape, dtype=np.int8)
        costs[1:, -1] = 2
        rows = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
        columns = [column[ch] for m in moves for ch in m]
        follows[rows, columns] = [to for m in moves for to in m.values()]
        costs[rows, columns] = 0
        self._follows.append((follows * width + self.size).ravel())
        self._costs.append(costs.ravel())
        self.languages.append(language)
        self.letters.append(letters)
        self.starts.append(self.size)
        self.size += follows.size

    def close(self) -> None:
        """Put the languages together."""
        if not self.languages:
            return
        self.follows, self.costs = np.concatenate(self._follows), np.concatenate(self._costs)
        self._follows, self._costs = [], []
        known = sorted(set().union(*self.letters))
        # Code point -> number among all letters, the last number for others; number -> column in each language.
        self.number = np.full(sys.maxunicode + 1, len(known), dtype=np.int32)
        self.number[[ord(ch) for ch in known]] = np.arange(len(known))
        self.column = np.tile(np.array([len(x) for x in self.letters], dtype=np.int32), (len(known) + 1, 1))
        for i, letters in enumerate(self.letters):
            self.column[self.number[[ord(ch) for ch in letters]], i] = np.arange(len(letters))

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (row) under each language (column); texts go by falling length, none is empty."""
        many = len(self.languages)
        lengths = np.array([len(t) for t in texts])
        start = np.tile(np.array(self.starts, dtype=np.int64), len(texts))
        # The phrase that is open, perhaps still empty, is counted.
        at, count = start.copy(), np.ones(len(start), dtype=np.int64)
        begin, longest = 0, int(lengths.max(initial=0))
        while begin < longest:
            there = int(np.count_nonzero(lengths > begin))
            steps = min(longest - begin, max(1, LOOKUPS // (there * many)))
            piece = "".join(t[begin:begin + steps].ljust(steps) for t in texts[:there])
            points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(there, steps)
            columns = self.column[self.number[points.T]].reshape(steps, there * many)
            # Texts that still have a letter are the first ones.
            ends = np.searchsorted(-lengths, -np.arange(begin, begin + steps)) * many
            for letters, n in zip(columns, ends.tolist()):
                cell = at[:n] + letters[:n]
                count[:n] += self.costs[cell]
                at[:n] = self.follows[cell]
            begin += steps
        return (count - (at == start)).reshape(len(texts), many)


@lru_cache(maxsize=1)
def automata(samples: tuple[tuple[str, str], ...]) -> tuple[tuple[dict, ...], Tables]:
    """The start state of each language, and the automata as an array."""
    gc.disable()
    try:
        starts, tables = [], Tables()
        for i, (_, sample) in enumerate(samples):
            moves = numbered_moves(sample)
            tables.add(i, moves)
            starts.append(linked(moves))
        tables.close()
        return tuple(starts), tables
    finally:
        gc.freeze()
        gc.enable()


def side_by_side(lows: list[str], samples: tuple[tuple[str, str], ...]) -> list[dict[int, int]]:
    """Phrases of each folded text by language, as far as they are known from parsing the texts together."""
    known: list[dict[int, int]] = [{} for _ in lows]
    if not samples:
        return known
    tables = automata(samples)[1]
    order = sorted((i for i, low in enumerate(lows) if low), key=lambda i: -len(lows[i]))[ALONE:]
    if not tables.languages or not order:
        return known
    for i, counts in zip(order, tables.phrases([lows[i] for i in order]).tolist()):
        known[i] = dict(zip(tables.languages, counts))
    return known


def best_of(low: str, samples: tuple[tuple[str, str], ...], known: dict[int, int]) -> tuple[str, float]:
    """Language and score of one folded text of which the phrases of some languages are ``known``."""
    if not low or not samples:
        return UNKNOWN, 0.0
    starts = automata(samples)[0]
    bits = math.log2(max(2, *(len(s) for _, s in samples)))
    counts = dict(known)
    if not counts:
        guess = min(range(len(starts)), key=lambda i: phrases(low[:GUESS_CHARS], starts[i]))
        counts[guess] = phrases(low, starts[guess])
    least = min(counts.values())
    for i in range(len(starts)):
        if i not in counts:
            counts[i] = phrases(low, starts[i], least + LOST_BITS / bits)
            least = min(least, counts[i])
    winner = min(counts, key=lambda i: (counts[i], i))
    return samples[winner][0], 1.0 / sum(2.0 ** (bits * (least - c)) for c in counts.values())


def best_language(text: str | None, samples: tuple[tuple[str, str], ...]) -> tuple[str, float]:
    """Language and score of one text; ``samples`` are pairs of language and text, in order."""
    return best_of(folded(text), samples, {})


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[tuple[str, str], ...]:
    """Samples of the languages, from rows with a label and a text."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    rows = rows.withColumn("key", F.xxhash64("text"))
    # Stored, so that its size is known where it meets the texts: one row for each language.
    sizes = store(rows.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n"))
                  .orderBy(F.desc("n"), "lang").limit(LANGUAGES))
    share = F.pmod("key", F.lit(1 << 40)) / float(1 << 40)
    offset = F.pmod("key", F.greatest(F.length("text") - PIECE_CHARS + 1, F.lit(1)).cast("long"))
    some = (rows.join(sizes, "lang").filter(share * F.col("n") < PIECES * SPARE)
            .groupBy("lang", "key").agg(F.min(F.substring("text", (offset + 1).cast("int"), F.lit(PIECE_CHARS))).alias("piece")))
    order = Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 40)), "key")
    picked = some.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= PIECES).collect()
    pieces: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["i"])):
        if low := folded(r["piece"]):
            pieces.setdefault(r["lang"], []).append(low)
    each = MODEL_CHARS // max(1, len(pieces))
    return tuple((name, BREAK.join(own)[:each]) for name, own in sorted(pieces.items()))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches in a row that hold about TOGETHER bytes of texts."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.column(1).nbytes
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def predicted(docs: DataFrame, samples: tuple[tuple[str, str], ...], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    small_batches(docs.sparkSession)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches):
            lows = [folded(t.as_py()) for batch in group for t in batch.column(1)]
            found = [best_of(low, samples, known) for low, known in zip(lows, side_by_side(lows, samples))]
            names, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column(0) for batch in group]),
                 pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(
        predict, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the labelled rows that are not held out."""
    samples = learn(docs.filter(~held_out(F.col(doc_id))), text, lang)
    return predicted(docs, samples, doc_id, text).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
