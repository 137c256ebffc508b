"""Reading the vocabulary files of public tokenizers, and the splits they prescribe."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import regex

# White space as the tokenizers see it, and the two files' split patterns.
SPACE = r"\t-\r \x85\xa0  -     　"
BYTE_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
              r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
WORD_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself where it is printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Vocabulary:
    """Symbols, merge ranks and special strings of a BPE file.

    ``ranks`` maps a pair of ids, packed into one integer, to (rank, id of the union)."""

    SHIFT = 32

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.ranks = {ids[a] << self.SHIFT | ids[b]: (rank, ids[a + b])
                      for rank, (a, b) in enumerate(map(self._pair, model["merges"]))}
        letters = byte_letters()
        self.byte_id = [ids[c] for c in letters]
        self.last_id = [ids[c + self.end] for c in letters]
        self.folds = spec["normalizer"] is not None
        self.split = regex.compile(WORD_SPLIT if self.folds else BYTE_SPLIT)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    @staticmethod
    def _pair(merge) -> tuple[str, str]:
        return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)

    def symbols(self, word: str) -> list[int]:
        """The ids of a word before any merge."""
        data = word.encode("utf-8")
        out = [self.byte_id[b] for b in data]
        out[-1] = self.last_id[data[-1]]
        return out

    def symbol_rows(self, words: list[str]) -> tuple[list[int], list[int]]:
        """The words' symbols before any merge, each word closed by -1, and the place of
        each word's first."""
        data = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, data), np.int64, len(data))
        ends = np.cumsum(size)
        flat = np.frombuffer(b"".join(data), np.uint8)
        out = np.full(len(flat) + len(words), -1, np.int64)
        out[np.arange(len(flat)) + np.repeat(np.arange(len(words)), size)] = np.array(self.byte_id)[flat]
        last = ends - 1 + np.arange(len(words))
        out[last] = np.array(self.last_id)[flat[ends - 1]]
        return out.tolist(), (last - size + 1).tolist()

    def folded(self, text: str) -> str:
        """The normal form that the file asks for: composed and in lower case, each
        character by itself (so no final sigma)."""
        if not self.folds:
            return text
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, string): special strings stand alone, before normalisation."""
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                yield True, part
            elif part:
                yield False, self.folded(part)


class Remembered(dict):
    """Results by word, computed once, of at most ``limit`` words at a time."""

    def __init__(self, compute: Callable[[str], object], limit: int):
        self.compute, self.limit = compute, limit

    def __missing__(self, word: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.compute(word)
        return value
