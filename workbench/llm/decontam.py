"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are split into words; a window is ``window`` consecutive words of an item, or a whole
shorter item. All items of a shard go into one automaton of their word sequences, which is
broadcast (a shard holds at most ``shard_words`` words; a larger benchmark makes more
shards, each one more pass over the documents). A document's words stream through it;
the length of the longest match that ends at each word says whether a window ends there,
and the state says which items have that window.

The automaton's first two levels are kept as sorted arrays of word and word-pair codes:
where two neighbouring words are no pair of an item, no match is longer than one word, so
only runs of pairs that are long enough for a window are walked state by state.

Defined results: null texts have no words; items without words match nothing; items that
share an id count once, a null id reads ''; no benchmark rows mean no hits; rows that
repeat are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workbench.llm.common import fresh, ship, shipped, slices, text_or_empty, texts
from workbench.llm.words import byte_table, hash_word, split_words

# The bytes of words (digits, letters, all beyond ASCII).
WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WINDOW, SHARD_WORDS, SLICE = 10, 200_000, 1 << 20
SPANS = "array<struct<first:int,last:int,start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")]))


class Automaton:
    """Generalised suffix automaton over sequences of word numbers, with the items that
    each state's window belongs to."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.go: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, seq in items:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        n = len(self.go)
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, seq in items:
            at = 0
            for i, c in enumerate(seq):
                at = self.go[at][c]
                if i + 1 >= window:
                    self.full.setdefault(self._holding(at, window), set()).add(name)
            if 0 < len(seq) < window:
                self.short.setdefault(self._holding(at, len(seq)), []).append((len(seq), name))
        # nearest state with a short item, the state itself included
        self.ends = [0] * n
        for s in sorted(range(1, n), key=self.size.__getitem__):
            self.ends[s] = s if s in self.short else self.ends[self.link[s]]

    def _extend(self, last: int, c: int) -> int:
        go, link, size = self.go, self.link, self.size
        if c in go[last]:
            q = go[last][c]
            return q if size[q] == size[last] + 1 else self._split(last, c, q)
        new = len(go)
        go.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        go, link, size = self.go, self.link, self.size
        copy = len(go)
        go.append(dict(go[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = copy
            p = link[p]
        return copy

    def _holding(self, state: int, length: int) -> int:
        """The state of the last ``length`` words read."""
        while self.size[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (first, last word) and items of a sequence of word numbers."""
        go, link, size = self.go, self.link, self.size
        at = matched = 0
        spans, items = [], set()
        for i, c in enumerate(words):
            while at and c not in go[at]:
                at = link[at]
                matched = size[at]
            if c not in go[at]:
                matched = 0
                continue
            at = go[at][c]
            matched += 1
            if matched >= self.window:
                items |= self.full[self._holding(at, self.window)]
                spans.append((i - matched + 1, i))
            u = self.ends[at]
            while u:
                for length, name in self.short[u]:
                    if length <= matched:
                        items.add(name)
                        spans.append((i - length + 1, i))
                u = self.ends[link[u]]
        return spans, items


def union(spans) -> list[tuple]:
    """Overlapping (first, last, ...) spans joined, in order."""
    out: list[list[int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1::2] = [max(a, b) for a, b in zip(out[-1][1::2], s[1::2])]
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


class Shard:
    """An automaton with the arrays that pick the runs to walk."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int, table: np.ndarray):
        self.words = sorted({w for _, seq in items for w in seq})
        hashes = np.array([hash_word(w, table) for w in self.words], np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.words = [self.words[k] for k in order]
        number = {w: k for k, w in enumerate(self.words)}
        seqs = [(name, [number[w] for w in seq]) for name, seq in items]
        pairs = {a * len(number) + b for _, s in seqs for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.least = min(window, *(len(s) for _, s in seqs)) if len(seqs) > 1 else \
            min(window, len(seqs[0][1]))
        self.automaton = Automaton(seqs, window)

    def runs(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word numbers or -1, first and last position of runs long enough for a window)."""
        n = len(hashes)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == hashes, at, -1)
        known = number >= 0
        joined = np.zeros(n, bool)  # to the word before
        joined[1:] = known[1:] & known[:-1]
        cut = first[1:-1]
        joined[cut[cut < n]] = False
        where = np.flatnonzero(joined)
        code = number[where - 1] * len(self.hashes) + number[where]
        if len(self.pairs):
            k = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined[where[self.pairs[k] != code]] = False
        else:
            joined[:] = False
        begin = np.flatnonzero(known & ~joined)
        follows = np.zeros(n + 1, bool)
        follows[:n] = joined
        end = np.flatnonzero(known & ~follows[1:])
        long = end - begin + 1 >= self.least
        return number, begin[long], end[long]


def shards_of(benchmark: DataFrame, id_col: str, text_col: str, window: int,
              shard_words: int) -> Iterator[Shard]:
    """Automata of at most ``shard_words`` words each (one item may be longer)."""
    table = byte_table(WORD_BYTES)
    held, n = [], 0
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_or_empty(text_col))
    for name, text in rows.toLocalIterator():
        seq = WORD.findall(text.encode("utf-8").translate(LOWER))
        if held and n + len(seq) > shard_words:
            yield Shard(held, window, table)
            held, n = [], 0
        if seq:
            held.append((name, seq))
            n += len(seq)
    if held:
        yield Shard(held, window, table)


def _matcher(shard, text_at: int, keep: list[int], names: list[str], old: tuple[int, int] | None):
    """mapInArrow function that adds (n_words, spans, items) to the columns ``keep``;
    ``old``: the places of the spans and items of earlier shards, which are joined in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Shard | None = shipped(shard) if shard is not None else None
        table = byte_table(WORD_BYTES)
        for batch in batches:
            data, ends = texts(batch.column(text_at))
            for a, b in slices(ends, SLICE):
                w = split_words(data, ends[a:b + 1], table)
                found: dict[int, tuple[list, set]] = {}
                if old:
                    for k in range(b - a):
                        spans = batch.column(old[0])[a + k].as_py()
                        if spans:
                            found[k] = ([tuple(x.values()) for x in spans],
                                        set(batch.column(old[1])[a + k].as_py()))
                if s is not None and len(w.hash):
                    number, begin, end = s.runs(w.hash, w.first)
                    for i, j in zip(begin.tolist(), end.tolist()):
                        seq = number[i:j + 1].tolist()
                        for k, c in enumerate(seq):  # the words themselves, not their hashes
                            word = data[w.start[i + k]:w.end[i + k]].tobytes().translate(LOWER)
                            if word != s.words[c]:
                                seq[k] = -1
                        spans, items = s.automaton.stream(seq)
                        if not spans:
                            continue
                        doc = int(np.searchsorted(w.first, i, side="right")) - 1
                        base, origin = int(w.first[doc]), int(ends[a + doc])
                        hits, names_of = found.setdefault(doc, ([], set()))
                        hits += [(i + x - base, i + y - base, int(w.start[i + x]) - origin,
                                  int(w.end[i + y]) - origin) for x, y in union(spans)]
                        names_of |= items
                blank = ([], set())
                rows = [found.get(k, blank) for k in range(b - a)]
                spans = [[dict(zip(("first", "last", "start", "end"), x)) for x in union(r[0])]
                         for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in keep),
                     pa.array(np.diff(w.first)), pa.array(spans, SPAN_TYPE),
                     pa.array([sorted(r[1]) for r in rows], pa.list_(pa.string()))], names)
    return run


def mark(docs: DataFrame, benchmark: DataFrame, *, keep: list[str] | None = None,
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         window: int = WINDOW, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs`` (all, unless given) with three more, whose names
    are returned: number of words, hit spans (words and bytes, both ends of words
    inclusive, the end byte exclusive), and ids of the items with a window in the text."""
    spark = docs.sparkSession
    keep = list(docs.columns) if keep is None else keep
    added = [fresh(docs.columns, x) for x in ("n_words", "spans", "items")]
    out, last = docs, None
    shards = iter([*(ship(spark, s) for s in shards_of(
        benchmark, item_col, item_text, window, shard_words))] or [None])
    shard = next(shards)
    while shard is not None or last is None:
        following = next(shards, None)
        base = keep if following is None else list(docs.columns)
        fields = [docs.schema[c] for c in base]
        schema = T.StructType([*fields, T.StructField(added[0], T.LongType()),
                               *T._parse_datatype_string(f"{added[1]} {SPANS}, {added[2]} array<string>").fields])
        cols = out.columns
        old = None if last is None else (cols.index(added[1]), cols.index(added[2]))
        run = _matcher(shard, cols.index(text_col), [cols.index(c) for c in base],
                       schema.names, old)
        out, last, shard = out.mapInArrow(run, schema), shard or 1, following
    return out, added


def n_hit(spans: str) -> Column:
    """Words covered by the spans."""
    return F.aggregate(F.col(spans), F.lit(0).cast("bigint"),
                       lambda n, s: n + s["last"] - s["first"] + 1)


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                  **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated) of every row."""
    marked, (words, spans, items) = mark(docs, benchmark, keep=[id_col], **options)
    return marked.select(
        F.col(id_col).alias("doc_id"), F.col(words).alias("n_words"), n_hit(spans).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"), F.col(items).alias("items"),
        F.col(spans).alias("spans"), (F.size(spans) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, max_span: int = 0,
                      max_coverage: float = 0.0, **options) -> DataFrame:
    """``docs`` without the rows that hold a hit span of over ``max_span`` words or whose
    hit words are over ``max_coverage`` of all; with the defaults, any hit."""
    marked, (words, spans, _) = mark(docs, benchmark, **options)
    longest = F.coalesce(F.array_max(F.transform(spans, lambda s: s["last"] - s["first"] + 1)), F.lit(0))
    share = n_hit(spans) / F.greatest(F.col(words), F.lit(1))
    return (marked.filter((longest <= max_span) & (share <= max_coverage))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def cut_spans(docs: DataFrame, benchmark: DataFrame, *, max_span: int = 0,
              text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each hit span of over ``max_span`` words cut out of its text; other
    texts, null ones too, stay as they are."""
    marked, (_, spans, _) = mark(docs, benchmark, text_col=text_col, **options)
    data = F.encode(F.col(text_col), "utf-8")
    long = F.filter(spans, lambda s: s["last"] - s["first"] + 1 > max_span)
    # pieces between the spans: (where the last span ended, bytes so far)
    folded = F.aggregate(
        long, F.struct(F.lit(0).alias("at"), F.lit(b"").alias("kept")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["kept"], F.substring(
            data, acc["at"] + 1, s["start"] - acc["at"])).alias("kept")))
    rest = F.concat(folded["kept"], F.substring(data, folded["at"] + 1, F.length(data)))
    cut = F.when(F.size(long) > 0, F.decode(rest, "utf-8")).otherwise(F.col(text_col))
    return marked.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`")
                           for c in docs.columns])
