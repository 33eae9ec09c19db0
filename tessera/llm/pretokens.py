"""Splitting texts into pre-tokens, as the byte-level BPE pattern does, in numpy.

The pattern (``public_tokenizers.PATTERN``) tries, at each place: a contraction; letters, digits or other signs
with one space in front; white space up to the last before something else; white space. As each
character is in one of four classes, its matches are the runs of a class, with four adjustments:
the last space of a run goes to what follows it, any other last white space stands alone, an apostrophe
takes its contraction from the letters that follow, and a text's end ends a run.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

from tessera.llm.common import exact_codes

OTHER, LETTER, DIGIT, SPACE = 0, 1, 2, 3
# fixed values: the white space of \s in the tokenizers' regular expressions (Unicode White_Space)
WHITE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point."""
    if not _classes:
        major = (unicodedata.category(chr(i))[0] for i in range(sys.maxunicode + 1))
        code = np.frombuffer("".join(major).encode(), np.uint8)
        table = np.zeros(len(code), np.uint8)
        table[code == ord("L")] = LETTER
        table[code == ord("N")] = DIGIT
        table[WHITE] = SPACE
        _classes.append(table)
    return _classes[0]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the pre-tokens of a slice of UTF-8 rows, and the index of each row's first (rows + 1)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    table = classes()
    lead = (data & 0xC0) != 0x80
    if lead.all():
        at, kind, char = None, table[data], data
        first = np.zeros(n, bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
    else:
        at = np.flatnonzero(lead)
        char = data[at].astype(np.uint32)
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        for low, high, keep, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
            k = np.flatnonzero((char >= low) & (char < high))
            if len(k):
                value = char[k] & keep
                for j in range(1, more + 1):
                    value = (value << 6) | (padded[at[k] + j] & 0x3F)
                char[k] = value | 0x80000000                # marked, so that no later range takes it again
        char &= 0x7FFFFFFF
        kind = table[char]
        first = np.zeros(len(at), bool)
        first[np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])] = True
    m = len(kind)
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # white space before something else, in the same row
    i = np.flatnonzero(start[1:] & ~first[1:] & (kind[:-1] == SPACE)) + 1
    start[i - 1] = True
    blank = i[char[i - 1] == 0x20]
    start[blank] = False
    # contractions
    i = np.flatnonzero(start & (char == 0x27))
    i = i[i + 1 < m]
    i = i[(kind[i + 1] == LETTER) & ~first[i + 1]]
    if len(i):
        after = np.minimum(i + 2, m - 1)
        one, two = char[i + 1], np.where((i + 2 < m) & ~first[after], char[after], 0)
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        size = np.where(np.isin(one, list(map(ord, "stmd"))), 1, np.where(pair, 2, 0))
        i, size = i[size > 0], size[size > 0]
        start[i + 1] = False
        rest = i + 1 + size
        ok = rest < m
        rest = rest[ok]
        start[rest[(kind[rest] == LETTER) & ~first[rest]]] = True
    begin = np.flatnonzero(start)
    if at is not None:
        begin = at[begin]
    return begin, np.searchsorted(begin, offsets)


def distinct(data: np.ndarray, begin: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pre-tokens: (bytes, start, end) of each, and each pre-token's index among them."""
    end = np.append(begin[1:], len(data))
    index, texts = exact_codes(data, end - begin)
    where = np.zeros(len(texts), np.int64)
    where[index[::-1]] = np.arange(len(index))[::-1]
    return texts.to_pylist(), begin[where], end[where], index
