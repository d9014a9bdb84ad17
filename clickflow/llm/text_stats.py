"""Statistics of one text, used by the quality rules and the quality classifier.

Words are runs of characters other than the six ASCII white-space characters, as
bytes.split() cuts them.  All counts are over the whole text; a null text has none.
"""

from __future__ import annotations

import re

import numpy as np

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
WINDOW = 5
#: Odd multipliers of the words in a window.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
LETTERS = re.compile(rb"[a-z]")
DETAIL = (*BASE, "n_chars", "n_upper", "n_digits", "n_punct", "n_distinct_words", "n_short_words", "n_marked_words")
PUNCTUATION = b"!\"'()+,-./:;=?@[\\]^_`{}~"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"


def repeat_words(words: list[bytes]) -> int:
    """Words in 5-word windows that the text has twice or more, the first included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=n).view(np.uint64)
    m = n - WINDOW + 1
    mixed = np.zeros(m, dtype=np.uint64)
    for k in range(WINDOW):
        mixed += (h[k:k + m] ^ (h[k:k + m] >> np.uint64(29))) * MIX[k]
    order = np.argsort(mixed)
    got = mixed[order]
    same = got[1:] == got[:-1]
    if not same.any():
        return 0
    again = np.zeros(m, dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    covered = np.zeros(n, dtype=bool)
    for k in range(WINDOW):
        covered[starts + k] = True
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in BASE."""
    if not text:
        return (0,) * len(BASE)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(BLANKS)]
    return (len(words), len(text) - (len(data) - len(data.translate(None, BLANKS))),
            len(data) - len(data.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeat_words(words))


def detail_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in DETAIL."""
    if not text:
        return (0,) * len(DETAIL)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(data)
    upper, digits, punct = (n - len(data.translate(None, x)) for x in (UPPER, DIGITS, PUNCTUATION))
    marks = SYMBOLS + b"!?"
    return (*base_counts(text), len(text), upper, digits, punct, len(set(words)),
            sum(len(w) <= 2 for w in words), sum(w[-1] in marks for w in words))
