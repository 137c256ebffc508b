"""Language-model scores from a log-bilinear neural model.

Tokens are the lower-cased words of a text, then one end. The model predicts a token from
the two before it (the end stands before a text's first): s(w | a, b) = (P1[a] + P2[b]) . Q[w]
+ bias[w], over the ``vocabulary`` most frequent words, the end and one class for all other
words. It is trained in numpy by noise-contrastive estimation on all training texts: in
each of ``rounds`` rounds every task makes steps over its share of that round's texts from the
common parameters, and the results are averaged, weighted by tokens, in a tree reduce.

As the score is a sum over the two positions, two matrix products give all scores of
(a, w) and (b, w), and a third, of their exponentials, the normaliser of every context (a, b).
Token log-probabilities are then exact and normalised. A word of the other class gets the
class's probability times its share of the class: (count + 1) of it, where one further
place is for words never seen.

Counts are of all training texts. The ``head`` most frequent words' counts go to every task;
those of the rest are joined to the texts that have them.

Defined results: a null or empty text is its end token alone; a row without id is a
training row; repeated rows are scored alike and count as often as they come; without
training rows every count is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log10
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import ship, shipped, stored, text_or_empty

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
VOCABULARY, WIDTH, ROUNDS, NOISE, BATCH, RATE = 2_046, 16, 3, 64, 1_024, 0.05
HEAD, FLUSH, SLICE = 200_000, 300_000, 200_000
END, OTHER, FIRST = 0, 1, 2  # classes; words follow
END_WORD = ""  # how the counts name the end; no word is empty


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(LOWER).split()


def held_out(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    """Whether the id's hash falls into the fold that is not learned from."""
    crc = F.crc32(F.encode(F.col(f"`{id_col}`").cast("string"), "utf-8"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == fold, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: texts to (word, n), added up within the task."""
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("utf-8") for w in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py()))
            counts[b""] += 1
            if len(counts) > FLUSH:
                yield rows(counts)
                counts = Counter()
    yield rows(counts)


class Parameters(NamedTuple):
    """Context rows for one and for two tokens back, target rows, bias."""

    one: np.ndarray
    two: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self])

    @staticmethod
    def shaped(flat: np.ndarray, n: int, d: int) -> Parameters:
        a, b, c, bias = np.split(flat, [n * d, 2 * n * d, 3 * n * d])
        return Parameters(a.reshape(n, d), b.reshape(n, d), c.reshape(n, d), bias)


class Tables(NamedTuple):
    """All scores and normalisers of a model."""

    one: np.ndarray      # [a, w]
    two: np.ndarray      # [b, w], with the bias
    normaliser: np.ndarray  # [a, b], natural log

    @staticmethod
    def of(p: Parameters) -> Tables:
        one, two = p.one @ p.target.T, p.two @ p.target.T + p.bias
        high1, high2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
        total = np.exp(one - high1) @ np.exp(two - high2).T
        return Tables(one, two, np.log(total) + high1 + high2.T)

    def log10(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (self.one[a, w] + self.two[b, w] - self.normaliser[a, b]).astype(np.float64) / np.log(10)


def contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One and two tokens back, in texts that follow each other and each close with END."""
    one, two = np.full(len(classes), END), np.full(len(classes), END)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    two[1:][one[1:] == END] = END  # nothing from the text before
    return one, two


def train(p: Parameters, classes: np.ndarray, share: np.ndarray, square: list[np.ndarray],
          random: np.random.Generator) -> Parameters:
    """Noise-contrastive steps (AdaGrad) over a run of tokens. ``share``: the noise
    distribution, the classes' shares of the corpus, whose logarithm is also the bias and
    stays as it is. NOISE draws serve a whole batch."""
    n, d = p.one.shape
    offset = np.log(NOISE * share).astype(np.float32)
    one, two = contexts(classes)
    edges = np.cumsum(share)
    params = [x.copy() for x in p]
    cells = np.arange(d)

    def summed(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        flat = (rows[:, None] * d + cells).ravel()
        return np.bincount(flat, values.ravel(), n * d).reshape(n, d).astype(np.float32)

    for k in range(0, len(classes), BATCH):
        a, b, w = one[k:k + BATCH], two[k:k + BATCH], classes[k:k + BATCH]
        noise = np.minimum(np.searchsorted(edges, random.random(NOISE)), n - 1)
        p1, p2, target, bias = params
        q = p1[a] + p2[b]
        real = (q * target[w]).sum(1) + bias[w] - offset[w]
        fake = q @ target[noise].T + bias[noise] - offset[noise]
        up = (-1 / (1 + np.exp(np.clip(real, -30, 30)))).astype(np.float32)
        down = (1 / (1 + np.exp(-np.clip(fake, -30, 30)))).astype(np.float32)
        back = up[:, None] * target[w] + down @ target[noise]
        grads = [summed(a, back), summed(b, back), summed(w, up[:, None] * q)]
        np.add.at(grads[2], noise, down.T @ q)
        for x, g, s in zip(params, grads, square):
            s += g * g
            x -= RATE * g / np.sqrt(s)
    return Parameters(*params)


def _trainer(sent):
    """mapInArrow function: texts to one row (tokens, parameters) of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, share, names = shipped(sent)
        number = {w: k + FIRST for k, w in enumerate(names)}
        square = [np.ones(x.shape, np.float32) for x in p[:3]]
        random = np.random.default_rng(11)
        done, held = 0, []

        def step(p: Parameters) -> Parameters:
            return train(p, np.array(held, np.int64), share, square, random)

        for batch in batches:
            for text in batch.column(0):
                held += [number.get(w, OTHER) for w in words_of(text.as_py())]
                held.append(END)
                if len(held) >= SLICE:
                    p, done, held = step(p), done + len(held), []
        p, done = step(p), done + len(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([done], pa.int64()), pa.array([p.flat().astype(np.float32).tobytes()], pa.binary())],
            ["tokens", "parameters"])
    return run


def _weighted(row) -> tuple[int, np.ndarray]:
    return row.tokens, np.frombuffer(row.parameters, np.float32).astype(np.float64) * row.tokens


def _added(a, b):
    return a[0] + b[0], a[1] + b[1]


class Model(NamedTuple):
    parameters: Parameters
    names: list[bytes]       # the vocabulary's words, most frequent first
    head: dict[bytes, int]   # counts of the most frequent words
    ends: int                # count of the end token
    tokens: int              # N
    distinct: int            # V
    rest: int                # sum of (count + 1) over words outside the vocabulary, and 1


def fit(docs: DataFrame, *, text_col: str = "text", vocabulary: int = VOCABULARY,
        width: int = WIDTH, rounds: int = ROUNDS, head: int = HEAD) -> tuple[Model, DataFrame]:
    """A model of the texts of ``docs``, and the table (word, n) of all its words' counts."""
    spark = docs.sparkSession
    rows = docs.select(text_or_empty(text_col).alias("text"))
    counts = stored(rows.mapInArrow(_count_words, "word string, n bigint").groupBy("word")
                    .agg(F.sum("n").alias("n")), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(head + 1).toArrow().to_pydict()
    known = {w.encode("utf-8"): c for w, c in zip(top["word"], top["n"]) if w != END_WORD}
    ends = dict(zip(top["word"], top["n"])).get(END_WORD)
    if ends is None:
        ends = counts.filter(F.col("word") == END_WORD).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    names = list(known)[:vocabulary]
    inside = sum(known[w] for w in names)
    other = total - ends - inside
    rest = other + max(0, distinct - (ends > 0) - len(names)) + 1
    share = np.array([ends, other, *(known[w] for w in names)], np.float64) + 1
    share /= share.sum()
    random = np.random.default_rng(5)
    n = len(share)
    p = Parameters(*(random.normal(0, 0.1, (n, width)).astype(np.float32) for _ in range(3)),
                   np.log(share).astype(np.float32))
    part = F.pmod(F.xxhash64("text"), F.lit(rounds))
    for k in range(rounds):
        sent = ship(spark, (p, share, names))
        trained = rows.filter(part == k).mapInArrow(_trainer(sent), "tokens bigint, parameters binary")
        seen, flat = trained.rdd.map(_weighted).treeReduce(_added, depth=3)
        if seen:
            p = Parameters.shaped((flat / seen).astype(np.float32), n, width)
    return Model(p, names, known, ends, total, distinct, rest), counts


def _scorer(sent):
    """mapInArrow function (id, held_out, text) to what each text's head words give, and its
    other words with their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shipped(sent)
        tables = Tables.of(m.parameters)
        place = {w: k for k, w in enumerate(m.head)}  # by count, the vocabulary first
        size = len(m.names)
        log_count = np.log10(np.array([*m.head.values(), 0], np.float64) + 1)  # -1: not in head
        share_of_rest = log10(m.rest)
        for batch in batches:
            k = 0
            while k < batch.num_rows:
                a, pieces, tail, n = k, [], [], 0
                while k < batch.num_rows and n < SLICE:
                    words = words_of(batch.column(2)[k].as_py())
                    at = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
                    tail.append([(w.decode("utf-8"), c) for w, c in
                                 Counter(words[i] for i in np.flatnonzero(at < 0)).items()])
                    pieces.append(at)
                    n, k = n + len(words) + 1, k + 1
                first = np.concatenate(([0], np.cumsum([len(x) + 1 for x in pieces])))
                at = np.concatenate([np.append(x, -2) for x in pieces])
                classes = np.where(at == -2, END, np.where((at >= 0) & (at < size), at + FIRST, OTHER))
                model = tables.log10(*contexts(classes), classes)
                counted = np.where(at == -2, log10(m.ends + 1), log_count[np.maximum(at, -1)])
                outside = classes == OTHER
                model += np.where(outside, counted - share_of_rest, 0)

                def per_text(x: np.ndarray) -> np.ndarray:
                    return np.add.reduceat(x, first[:-1])

                found = per_text(((at >= 0) | ((at == -2) & (m.ends > 0))).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, k - a), batch.column(1).slice(a, k - a),
                     pa.array(np.diff(first)), pa.array(found), pa.array(per_text(counted)),
                     pa.array(per_text(model)),
                     pa.array(tail, pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())])))],
                    ["id", "held_out", "n_tokens", "found", "counted", "model", "tail"])
    return run


def score(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text",
          **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row,
    with a model of the rows where ``learn`` holds. Scores are log10 probabilities: of the
    add-one unigram base, and of the model."""
    model, counts = fit(docs.filter(learn), text_col=text_col, **options)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (~learn).alias("held_out"),
                       text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = stored(rows.mapInArrow(
        _scorer(ship(docs.sparkSession, model)),
        f"id {kind}, held_out boolean, n_tokens bigint, found bigint, counted double, model double, "
        "tail array<struct<word:string,times:bigint>>")
        .withColumn("r", F.monotonically_increasing_id()), "lm-scored")
    tail = (scored.select("r", F.inline("tail")).join(counts, "word")
            .groupBy("r").agg(F.sum("times").alias("tail_known"),
                              F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_log")))
    more = F.coalesce("tail_log", F.lit(0.0))
    return scored.join(tail, "r", "left").select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens",
        (F.col("found") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * F.lit(log10(model.tokens + model.distinct + 1)))
        .alias("base_score"),
        (F.col("model") + more).alias("score"))


def fold_scores(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``score`` with the fold of ``held_out`` left out of the training."""
    return score(docs, ~held_out(id_col), id_col=id_col, **options)
