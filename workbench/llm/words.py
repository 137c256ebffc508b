"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# A random multiplier for each byte position in a word.
_POSITIONS = 4096
_FACTORS = np.random.default_rng(20_240_229).integers(0, 2**64, _POSITIONS, dtype=np.uint64) | np.uint64(1)


def byte_table(inside: bytes) -> np.ndarray:
    """Byte to byte in lower case (A-Z only), 0 for bytes that no word has."""
    table = np.zeros(256, np.uint8)
    for b in inside:
        table[b] = b + 32 if 65 <= b <= 90 else b
    return table


class Words(NamedTuple):
    """Words in order of the texts: hash, first byte, byte after the last (both counted
    in the whole column), and for each text the number of its first word (one more
    number at the end)."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def split_words(data: np.ndarray, ends: np.ndarray, table: np.ndarray) -> Words:
    """The maximal runs of word bytes of each text; words with one lower-case form have
    one hash."""
    base, stop = int(ends[0]), int(ends[-1])
    seg = table[data[base:stop]]
    inside = seg != 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = ends[1:-1] - base
    edge = edge[(edge > 0) & (edge < len(seg))]
    opens[edge] = inside[edge]  # a word does not run on into the next text
    closes[edge - 1] = inside[edge - 1]
    start, last = np.flatnonzero(opens), np.flatnonzero(closes)
    size = last - start + 1
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(ends), np.int64))
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    kept = seg[inside].astype(np.uint64)
    at = np.arange(len(kept)) - np.repeat(begin, size)
    h = np.add.reduceat(kept * _FACTORS[at & (_POSITIONS - 1)], begin)
    h ^= h >> np.uint64(29)
    h = (h + size.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return Words(h, start + base, last + 1 + base, np.searchsorted(start, ends - base))


def stem_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray,
               size: int) -> np.ndarray:
    """The first ``size`` (at most 8) bytes of words as one integer, 0 for shorter words."""
    out = np.zeros(len(start), np.uint64)
    long = end - start >= size
    for k in range(size):
        out[long] = out[long] << np.uint64(8) | table[data[start[long] + k]].astype(np.uint64)
    return out


def first_of_text(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places, in order, of one occurrence of each key in each text; ``owner`` ascends."""
    both = keys ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(both)
    ranked = both[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return np.sort(order[new])


def hash_word(word: bytes, table: np.ndarray) -> int:
    """The hash that ``split_words`` gives this word."""
    data = np.frombuffer(word, np.uint8)
    return int(split_words(data, np.array([0, len(word)]), table).hash[0])
