"""Counts of one text, shared by the quality rules and the quality classifier."""

from __future__ import annotations

from collections import Counter

import numpy as np

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
#: ASCII punctuation that prose seldom has.
MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,?!'\"-():;")
PUNCTUATION = np.array([i for i in range(33, 127) if not chr(i).isalnum()])
WINDOW = 5


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == n:
        return 0
    found = Counter(windows)
    covered = np.zeros(n + WINDOW, dtype=np.int64)
    starts = np.fromiter((i for i, w in enumerate(windows) if found[w] > 1), dtype=np.int64)
    covered[starts] += 1
    covered[starts + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(covered)))


def line_counts(raw: bytes) -> tuple[int, int]:
    """Lines that hold a word, and how many of them equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


#: What rule_counts returns, in order.
RULE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
               "n_distinct", "n_upper", "n_stops", "n_bangs", "n_marks")


def rule_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = encoded(text)
    words = raw.split()
    lines, dup = line_counts(raw)
    chars = len(text) - sum(map(text.count, SPACES))
    return (len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeated_words(words), lines,
            len(set(words)), len(raw) - len(raw.translate(None, UPPER)),
            text.count(".") + text.count("?"), text.count("!"), len(raw) - len(raw.translate(None, MARKS)))


N_FEATURES = 12 + len(PUNCTUATION)


def features(text: str | None) -> np.ndarray:
    """Dense features of a text; every share lies between 0 and a small number."""
    raw = encoded(text)
    words = raw.split()
    n, size = len(words), len(raw)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    lines, dup = line_counts(raw)
    per_word = 1.0 / max(n, 1)
    per_byte = 1.0 / max(size, 1)
    pairs = list(zip(words, words[1:]))
    shares = np.log1p(4.0 * counts[PUNCTUATION] * per_word)
    own = (
        np.log1p(n), size * per_word / 8.0, dup / max(lines, 1), lines * per_word,
        len(set(words)) * per_word, len(set(pairs)) / max(len(pairs), 1) if pairs else 1.0,
        sum(a == b for a, b in pairs) * per_word, counts[65:91].sum() * per_byte,
        counts[97:123].sum() * per_byte, counts[48:58].sum() * per_byte, counts[128:].sum() * per_byte,
        float(n < 10),
    )
    return np.concatenate([own, shares]).astype(np.float32)
