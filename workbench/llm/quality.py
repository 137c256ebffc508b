"""Quality classifier from weak labels.

Labellers look at a text and vote for one of six classes (clean, or one kind of fault:
symbols, shouting, repetition, tables, toxic), or abstain; each fault has several overlapping
ones. Two of them learn from the labels that some documents have: a lexicon of words and
stems that come in toxic documents only, and the label itself, where there is one. No labeller is
trusted as it is: expectation-maximisation over the counts of all vote patterns in the whole
table estimates the classes' shares and each labeller's vote probabilities in each class.
The resulting posterior probability of a fault is the soft label with which a hashed linear
scorer (words, stems and bands of measures hashed into 2^20 weights, logistic loss) is
trained; the scorer decides about every document.

Parameter ``fit_rows`` bounds the posterior-labelled documents that the scorer is fitted on,
``label_rows`` the given labels that are used; both take the smallest hashes. Votes,
patterns and scores cover all documents. What reaches the driver is the pattern counts (as
many as there are combinations of votes: some hundreds), the lexicon (at most ``STEMS``)
and the sample's feature numbers.

Defined results: a null or empty text has no votes, and its score is the scorer's for a
text without words; equal texts get equal scores; ids may repeat or be null; of labels that
share an id the worst counts, null ones not at all; without labels the two labellers
abstain; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workbench.llm.common import fresh, released, ship, shipped, slices, stored, text_or_empty, texts
from workbench.llm.words import byte_table, first_of_text, hash_word, split_words, stem_codes

CLASSES = ("clean", "symbols", "shouting", "repetition", "tables", "toxic")
ABSTAIN, CLEAN, SYMBOLS, SHOUTING, REPETITION, TABLES, TOXIC = range(-1, 6)
# A given label says that a text is bad, not why; votes are written as digits below 8.
BAD, DIGITS = 6, 8
FIT_ROWS, LABEL_ROWS, STEMS, BITS, SLICE, THRESHOLD = 20_000, 50_000, 20_000, 20, 1 << 20, 0.5
STEM_BYTES = (4, 5, 6, 7, 8)
FALSE_ALARM, SEEN = 0.02, 0.3
# A toxic stem: in so many toxic documents, and such a share of them; and how many others.
STEM_LEAST, STEM_SHARE, STEM_ERROR = 5, 0.01, 0.02

# Common English insults.
INSULTS = (
    "stupid idiot idiots idiotic moron morons moronic trash scum loser losers pathetic worthless disgusting clown "
    "clowns dumb dumbass imbecile imbeciles fool fools jerk jerks bastard bastards bitch bitches asshole "
    "assholes crap shit shitty fuck fucking fucker damn hate hateful ugly freak freaks garbage vermin "
    "filth filthy filthbag pig pigs creep creeps lunatic retard retarded degenerate coward cowards parasite parasites scumbag "
    "dirtbag lowlife nitwit dimwit halfwit blockhead dunce twat prick wanker slut whore cunt"
).split()
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(0x80, 0x100)])
VISIBLE = bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13)
MARKS = b"#$%&*@^~|<>{}[]=+\\_/"
MEASURES = ("symbols", "marked", "capitals", "exclamations", "repetition", "long_repetition",
            "tables", "sentence", "insults", "stems", "words")


class Facts(NamedTuple):
    """Measures of texts (one row each) and the hashes of their distinct letter words, with
    the number of each text's first one."""

    measures: np.ndarray
    words: np.ndarray
    first: np.ndarray


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def _runs_repeated(tokens: np.ndarray, owner: np.ndarray, length: int, n: int) -> np.ndarray:
    """Share of a text's runs of ``length`` tokens that it has had before."""
    m = len(tokens) - length + 1
    if m <= 0:
        return np.zeros(n)
    keys = np.zeros(m, np.uint64)
    for k in range(length):
        keys = keys * np.uint64(0x100000001B3) + tokens[k:k + m]
    within = owner[:m] == owner[length - 1:]
    keys, own = keys[within], owner[:m][within]
    runs = np.bincount(own, minlength=n)
    distinct = np.bincount(own[first_of_text(keys, own)], minlength=n)
    return 1 - distinct / np.maximum(runs, 1) - (runs == 0)


class Reader:
    """Measures texts; ``stems``: sorted hashes of toxic stems."""

    def __init__(self, stems: np.ndarray):
        self.letters, self.visible = byte_table(LETTERS), byte_table(VISIBLE)
        self.counted = {"symbols": _flags(MARKS), "capitals": _flags(bytes(range(65, 91))),
                        "ascii": _flags(bytes([*range(65, 91), *range(97, 123)])),
                        "exclamations": _flags(b"!"), "stops": _flags(b".")}
        self.insults = np.sort(np.array([hash_word(w.encode(), self.letters) for w in INSULTS], np.uint64))
        self.stems = stems
        self.bar = hash_word(b"|", self.visible)

    def distinct_words(self, data: np.ndarray, ends: np.ndarray):
        """Each text's distinct letter words: hashes, first and last bytes, owners."""
        w = split_words(data, ends, self.letters)
        owner = np.repeat(np.arange(len(ends) - 1), np.diff(w.first))
        at = first_of_text(w.hash, owner)
        return w.hash[at], w.start[at], w.end[at], owner[at]

    def stems_of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
        """Stem of each word; unlike for different sizes, 0 for shorter words."""
        code = stem_codes(data, start, end, self.letters, size)
        return code * np.uint64(2 * size + 1)

    def read(self, data: np.ndarray, ends: np.ndarray) -> Facts:
        n = len(ends) - 1
        seg, at = data[ends[0]:ends[-1]], ends - ends[0]

        def count(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(flags)))
            return (total[places[1:]] - total[places[:-1]]).astype(np.float64)

        byte = {k: count(t[seg], at) for k, t in self.counted.items()}
        size = np.maximum(np.diff(ends), 1)
        tokens = split_words(data, ends, self.visible)
        n_tokens = np.diff(tokens.first).astype(np.float64)
        some = np.maximum(n_tokens, 1)
        owner = np.repeat(np.arange(n), np.diff(tokens.first))
        words, start, end, of = self.distinct_words(data, ends)
        first = np.searchsorted(of, np.arange(n + 1))
        stems = _among(words, self.stems)
        for k in STEM_BYTES if len(self.stems) else ():
            stems |= _among(self.stems_of(data, start, end, k), self.stems)
        marked = self.counted["symbols"][data[tokens.end - 1]] & (tokens.end - tokens.start > 1)
        columns = {
            "symbols": byte["symbols"] / size,
            "marked": count(marked, tokens.first) / some,
            "capitals": byte["capitals"] / np.maximum(byte["ascii"], 1),
            "exclamations": byte["exclamations"] / some,
            "repetition": _runs_repeated(tokens.hash, owner, 3, n),
            "long_repetition": _runs_repeated(tokens.hash, owner, 8, n),
            "tables": count(tokens.hash == self.bar, tokens.first) / some,
            "sentence": some / np.maximum(byte["stops"], 0.5),
            "insults": count(_among(words, self.insults), first),
            "stems": count(stems, first),
            "words": n_tokens,
        }
        return Facts(np.stack([columns[m] for m in MEASURES], 1), words, first)


def _among(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros(len(keys), bool)
    return chosen[np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)] == keys


def votes(measures: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
    """One column per labeller: the class it votes for, or ABSTAIN; the last is the given
    label."""
    m = dict(zip(MEASURES, measures.T))
    text, none = m["words"] > 0, np.zeros(len(measures), bool)

    def pick(fault: int, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(text, np.where(bad, fault, np.where(good, CLEAN, ABSTAIN)), ABSTAIN)

    return np.stack([
        pick(SYMBOLS, m["symbols"] > 0.06, m["symbols"] < 0.02),
        pick(SYMBOLS, m["marked"] > 0.3, m["marked"] < 0.1),
        pick(SHOUTING, m["capitals"] > 0.5, m["capitals"] < 0.2),
        pick(SHOUTING, m["exclamations"] > 0.2, m["exclamations"] < 0.05),
        pick(REPETITION, m["repetition"] > 0.5, m["repetition"] < 0.2),
        pick(REPETITION, m["long_repetition"] > 0.5, m["long_repetition"] < 0.1),
        pick(TABLES, m["tables"] > 0.1, m["tables"] < 0.02),
        pick(TABLES, m["sentence"] > 60, (m["sentence"] > 2) & (m["sentence"] < 30)),
        pick(TOXIC, m["insults"] >= 1, none),
        pick(TOXIC, m["stems"] >= 1, none),
        pick(TOXIC, m["insults"] + m["stems"] >= 2, m["insults"] + m["stems"] == 0),
        np.full(len(measures), ABSTAIN) if given is None else given,
    ], 1).astype(np.int8)


LABELLERS = votes(np.zeros((1, len(MEASURES)))).shape[1]


def pattern(v: np.ndarray) -> np.ndarray:
    """A row of votes as one integer."""
    return ((v.astype(np.int64) + 1) * DIGITS ** np.arange(LABELLERS)).sum(1)


def unpacked(patterns: np.ndarray) -> np.ndarray:
    """Rows of votes of ``pattern`` integers."""
    return ((patterns[:, None] // DIGITS ** np.arange(LABELLERS)) % DIGITS - 1).astype(np.int8)


class LabelModel(NamedTuple):
    prior: np.ndarray  # of each class
    vote: np.ndarray   # [labeller, class, vote + 1]

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of each class (columns) for rows of votes."""
        told = np.log(self.vote)
        told[:, :, ABSTAIN + 1] = 0  # no vote, no evidence
        log = np.log(self.prior) + sum(told[j][:, v[:, j] + 1].T for j in range(v.shape[1]))
        p = np.exp(log - log.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def fit_labels(v: np.ndarray, n: np.ndarray, *, rounds: int = 100, tol: float = 1e-9) -> LabelModel:
    """Expectation-maximisation from vote patterns ``v`` that ``n`` documents have each.

    A labeller that ever votes for a fault starts with most weight on that vote in the
    fault's class, and on ``clean`` in all others; a little is added to every count, so that a pattern never seen has a probability. Labellers are taken to
    be better than chance: a fault is seen in the documents of other classes at most with
    FALSE_ALARM, and where it is by each of its labellers at least with SEEN, which also
    keeps the classes' names in place."""
    k, j = len(CLASSES), v.shape[1]
    sees = np.array([(v == c).any(0) for c in range(k)]).T  # [labeller, class]
    start = np.full((j, k, DIGITS), 0.01)
    start[:, :, CLEAN + 1] = 0.9
    for c in range(1, k):
        start[sees[:, c], c, CLEAN + 1] = 0.2
        start[sees[:, c], c, c + 1] = 0.7
    told = (v == BAD).any(0)  # by the given label
    start[told, 1:, BAD + 1] += 0.4
    model = LabelModel(np.array([0.75] + [0.25 / (k - 1)] * (k - 1)),
                       start / start.sum(2, keepdims=True))
    for _ in range(rounds):
        held = model.posterior(v) * n[:, None]
        prior = held.sum(0) + 1
        vote = np.full((j, k, DIGITS), 0.1)
        for col in range(j):
            for c in range(k):
                vote[col, c] += np.bincount(v[:, col] + 1, held[:, c], DIGITS)
        vote[:, :, ABSTAIN + 1] = 0.1
        vote /= vote.sum(2, keepdims=True)
        for c in range(k):
            for fault in (*range(1, k), BAD):
                if fault != c and not (fault == BAD and c):
                    over = np.maximum(vote[:, c, fault + 1] - FALSE_ALARM, 0)
                    vote[:, c, fault + 1] -= over
                    vote[:, c, CLEAN + 1] += over
            if c:
                vote[sees[:, c], c, c + 1] = np.maximum(vote[sees[:, c], c, c + 1], SEEN)
        new = LabelModel(prior / prior.sum(), vote / vote.sum(2, keepdims=True))
        moved = abs(new.prior - model.prior).max() + abs(new.vote - model.vote).max()
        model = new
        if moved < tol:
            break
    return model


def features(facts: Facts) -> tuple[np.ndarray, np.ndarray]:
    """(weight numbers, place of each text's first): every distinct word under two hashes,
    each measure's band under one."""
    n = len(facts.first) - 1
    shift = np.uint64(64 - BITS)
    a = (facts.words * np.uint64(0x9E3779B97F4A7C15)) >> shift
    b = (facts.words * np.uint64(0xC2B2AE3D27D4EB4F)) >> shift
    bands = np.floor(8 * np.log2(1 + 16 * facts.measures)).astype(np.uint64)
    bands = bands + np.arange(len(MEASURES), dtype=np.uint64) * np.uint64(1 << 12) + np.uint64(1)
    c = (bands * np.uint64(0xD6E8FEB86659FD93)) >> shift
    owner = np.concatenate([np.repeat(np.arange(n), np.diff(facts.first))] * 2
                           + [np.repeat(np.arange(n), len(MEASURES))])
    order = np.argsort(owner, kind="stable")
    numbers = np.concatenate((a, b, c.ravel())).astype(np.int32)[order]
    return numbers, np.searchsorted(owner[order], np.arange(n + 1))


class Scorer(NamedTuple):
    weight: np.ndarray
    bias: float

    def probability(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of rejection, for each text."""
        total = np.concatenate(([0.0], np.cumsum(self.weight[numbers], dtype=np.float64)))
        z = self.bias + total[first[1:]] - total[first[:-1]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_scorer(rows: list[np.ndarray], target: np.ndarray, *, epochs: int = 10, rate: float = 0.2,
               batch: int = 128, least: int = 4, decay: float = 1e-6) -> Scorer:
    """Logistic regression on soft labels by AdaGrad; numbers that under ``least`` rows have
    keep weight zero."""
    size = 1 << BITS
    weight, square = np.zeros(size, np.float32), np.full(size, 1e-6, np.float32)
    seen = np.zeros(size, np.int64)
    for r in rows:
        seen[np.unique(r)] += 1
    rows = [r[seen[r] >= least] for r in rows]
    p = float(np.clip(target.mean(), 1e-4, 1 - 1e-4)) if len(target) else 0.0
    bias = float(np.log(p / (1 - p))) if p else -10.0
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
            if not len(part):
                continue
            idx = np.concatenate([rows[k] for k in part])
            first = np.concatenate(([0], np.cumsum([len(rows[k]) for k in part])))
            gap = Scorer(weight, bias).probability(idx, first) - target[part]
            used, where = np.unique(idx, return_inverse=True)
            grad = np.bincount(where, np.repeat(gap, np.diff(first)), len(used)) / len(part)
            grad += decay * weight[used]
            square[used] += grad ** 2
            weight[used] -= rate * grad / np.sqrt(square[used])
            bias -= rate * float(gap.mean())
    return Scorer(weight, bias)


def _stem_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function (text, toxic) to (stem, toxic documents, others) of a task."""
    reader = Reader(np.zeros(0, np.uint64))
    keys, bad, good = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        data, ends = texts(batch.column(0))
        flags = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(ends, SLICE):
            words, start, end, of = reader.distinct_words(data, ends[a:b + 1])
            for stems in (words, *(reader.stems_of(data, start, end, k) for k in STEM_BYTES)):
                at = first_of_text(stems, of)
                toxic = flags[a:b][of[at]]
                keys, at = np.unique(np.concatenate((keys, stems[at])), return_inverse=True)
                bad = np.bincount(at, np.concatenate((bad, toxic)), len(keys)).astype(np.int64)
                good = np.bincount(at, np.concatenate((good, 1 - toxic)), len(keys)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bad), pa.array(good)],
                                     ["stem", "bad", "good"])


def _labelled(rows: DataFrame, given: DataFrame) -> DataFrame:
    """``rows`` with ``given`` votes (ABSTAIN where there is none); ``given`` is bounded."""
    return (rows.join(F.broadcast(given), "key", "left")
            .withColumn("given", F.coalesce("given", F.lit(ABSTAIN))))


def toxic_stems(rows: DataFrame, given: DataFrame) -> np.ndarray:
    """Sorted hashes of the words and stems that labelled toxic documents share and others
    lack; of equal texts one counts."""
    known = (rows.join(F.broadcast(given), "key").select("text", (F.col("given") == TOXIC).alias("toxic"))
             .groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.first("text").alias("text"))
             .select("text", F.col("toxic").cast("int").alias("toxic")))
    known = stored(known, "quality-labelled")
    n = known.filter("toxic = 1").count()
    counted = (known.mapInArrow(released(_stem_counter), "stem bigint, bad bigint, good bigint")
               .groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
               .filter((F.col("stem") != 0) & (F.col("bad") >= max(STEM_LEAST, STEM_SHARE * n))
                       & (F.col("good") <= STEM_ERROR * F.col("bad"))))
    best = counted.orderBy(F.desc("bad"), "stem").limit(STEMS).select("stem").toArrow()
    return np.sort(best.column("stem").to_numpy().astype(np.int64).view(np.uint64))


def _measurer(one_in: int, sent):
    """mapInArrow function (text, h, given) to (pattern, h, features): features only of
    rows whose hash falls into the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped(sent))
        for batch in batches:
            data, ends = texts(batch.column(0))
            given = batch.column(2).to_numpy()
            for a, b in slices(ends, SLICE):
                facts = reader.read(data, ends[a:b + 1])
                h = batch.column(1).slice(a, b - a)
                chosen = h.to_numpy() % one_in == 0
                rows: list = [None] * (b - a)
                if chosen.any():
                    numbers, first = features(facts)
                    for k in np.flatnonzero(chosen):
                        rows[k] = numbers[first[k]:first[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pattern(votes(facts.measures, given[a:b]))), h,
                     pa.array(rows, pa.list_(pa.int32()))], ["pattern", "h", "numbers"])
    return run


class Model(NamedTuple):
    stems: np.ndarray
    labels: LabelModel
    scorer: Scorer


def _key(id_col: str):
    return F.xxhash64(F.col(f"`{id_col}`").cast("string"))


def given_votes(labels: DataFrame, id_col: str, label_rows: int) -> DataFrame:
    """(key, given) of at most ``label_rows`` ids that have a label."""
    vote = (F.when(F.col("toxic") == 1, TOXIC).when(F.col("quality") == 0, BAD)
            .when((F.col("toxic") == 0) & (F.col("quality") == 1), CLEAN))
    return (labels.filter(F.col(f"`{id_col}`").isNotNull())
            .select(_key(id_col).alias("key"), vote.alias("given"))
            .filter(F.col("given").isNotNull())
            .groupBy("key").agg(F.max("given").alias("given")).orderBy("key").limit(label_rows))


def fit(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id",
        text_col: str = "text", fit_rows: int = FIT_ROWS, label_rows: int = LABEL_ROWS) -> Model:
    """Label model over all rows of ``docs`` and a scorer fitted on at most ``fit_rows``.
    ``labels``: (id, quality 0/1, toxic 0/1) of some of them."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(text.alias("text"), _key(id_col).alias("key"),
                       F.xxhash64(F.col(f"`{id_col}`"), text)
                       .bitwiseAND(F.lit((1 << 62) - 1)).alias("h"))
    if labels is None:
        given = spark.createDataFrame([], "key bigint, given int")
    else:
        given = stored(given_votes(labels, id_col, label_rows), "quality-labels")
    stems = toxic_stems(rows, given)
    one_in = max(1, -(-docs.count() // fit_rows))
    measured = stored(_labelled(rows, given).select("text", "h", "given").mapInArrow(
        released(_measurer(one_in, ship(spark, stems))), "pattern bigint, h bigint, numbers array<int>"),
        "quality-measures")
    counts = measured.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    v = unpacked(np.array([c["pattern"] for c in counts], np.int64))
    label_model = fit_labels(v, np.array([c["n"] for c in counts], np.float64))
    sample = (measured.filter("numbers is not null").orderBy("h", "pattern").limit(fit_rows)
              .select("pattern", "numbers").toArrow())
    reject = 1 - label_model.posterior(unpacked(sample.column("pattern").to_numpy()))[:, CLEAN]
    numbers = sample.column("numbers").combine_chunks()
    flat, ends = numbers.values.to_numpy(), numbers.offsets.to_numpy()
    scorer = fit_scorer([flat[a:b] for a, b in zip(ends, ends[1:])], reject)
    return Model(stems, label_model, scorer)


def _judge(sent, text_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shipped(sent)
        reader = Reader(model.stems)
        for batch in batches:
            data, ends = texts(batch.column(text_at))
            for a, b in slices(ends, SLICE):
                facts = reader.read(data, ends[a:b + 1])
                p = model.labels.posterior(votes(facts.measures))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in keep),
                     pa.array(model.scorer.probability(*features(facts))),
                     pa.array(1 - p[:, CLEAN] - p[:, TOXIC]), pa.array(p[:, TOXIC])], names)
    return run


def judge(docs: DataFrame, model: Model, *, keep: list[str] | None = None,
          text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs`` (all, unless given) with three more, whose names are
    returned: the scorer's probability of rejection, and the label model's of junk of any
    kind and of toxic."""
    keep = list(docs.columns) if keep is None else keep
    added = [fresh(docs.columns, x) for x in ("score", "junk", "toxic")]
    schema = T.StructType([*(docs.schema[c] for c in keep),
                           *(T.StructField(x, T.DoubleType()) for x in added)])
    run = _judge(ship(docs.sparkSession, model), docs.columns.index(text_col),
                 [docs.columns.index(c) for c in keep], schema.names)
    return docs.mapInArrow(released(run), schema), added


def classify(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id",
             text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, kept, score, junk, toxic) of every row."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    judged, (score, junk, toxic) = judge(docs, model, keep=[id_col], text_col=text_col)
    return judged.select(F.col(f"`{id_col}`").alias("doc_id"), (F.col(score) < threshold).alias("kept"),
                         F.col(score).alias("score"), F.col(junk).alias("junk"), F.col(toxic).alias("toxic"))


def keep_good(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that the scorer does not reject, all columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    judged, (score, _, _) = judge(docs, model, text_col=text_col)
    return judged.filter(F.col(score) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
