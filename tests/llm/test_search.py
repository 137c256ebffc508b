import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import COLUMNS, LOWER, edge_docs, edge_rows, empty_docs
from workbench.llm import search

ITEM_COLUMNS = "item_id bigint, text string, rank int, score string, slot int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, top=10):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every item."""
    words = [terms(t) for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words))
    counts = [Counter(w) for w in words]
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = defaultdict(int)
        for t, times in Counter(terms(text)).items():
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            for k, c in enumerate(counts):
                if c[t]:
                    m = 100 - 75 + (75 * len(words[k]) * n_docs) // n_terms
                    scores[k] += times * weight * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
        best = sorted((-s, docs[k][0] is None, docs[k][0] or 0) for k, s in scores.items() if s > 0)[:top]
        out += [(item_id, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(best)]
    return sorted(out, key=str)


def made_up(n, seed, words=300):
    """Texts of words with unlike frequencies; a third are copies of one text."""
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(words)]
    share = [1 / (k + 1) for k in range(words)]
    def text():
        return " ".join(rng.choices(names, share, k=rng.randint(0, 60)))
    one = text()
    return [(k * 7 % n, one if rng.random() < 0.33 else text()) for k in range(n)]


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, *[None] * 11) for i, t in docs], COLUMNS).repartition(3)
    q = spark.createDataFrame([(i, t, None, None, None) for i, t in items], ITEM_COLUMNS)
    return sorted(map(tuple, search.ranked(d, q, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"block": 16}, {"block": 7, "top": 3}, {"shares": (3,), "block": 40}])
def test_equals_plain_version(spark, options):
    docs = made_up(400, 1)
    items = [(k, t) for k, (_, t) in enumerate(made_up(30, 2)) if t] + [(5, docs[3][1]), (5, docs[3][1] + " w1 w1")]
    assert run(spark, docs, items, **options) == plain(docs, items, options.get("top", 10))


def test_edges(spark):
    items = [(1, "the SAME text"), (1, "the SAME text"), (2, None), (3, ""), (4, "nowhere"), (None, "a b"),
             (6, "é日本 555 word0 word1")]
    docs = [r[:2] for r in edge_rows()]
    want = plain(docs, items)
    assert run(spark, docs, items) == want
    assert {r[0] for r in want} == {1, None, 6}
    q = spark.createDataFrame([(i, t, None, None, None) for i, t in items], ITEM_COLUMNS)
    assert search.ranked(empty_docs(spark), q).count() == 0
    assert search.ranked(edge_docs(spark), q.limit(0)).count() == 0


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(search, "PIECE", 50)
    text = "Alpha,beta;日本 x1 " * 500
    assert search.term_counts(text.encode()) == {t.encode(): n for t, n in Counter(terms(text)).items()}


def test_accumulators_that_cannot_reach_the_top_are_left(spark):
    """What a stage passes on is bounded, and a tie with the bound stays."""
    import numpy as np
    import pyarrow as pa
    stage = search._owner_stage(2)
    left = pa.table({"bundle": [0], "block": [0], "ids": [[10, 11, 12, 13]], "m": [[100, 100, 100, 100]],
                     "slots": [[3]], "rest": [[5]], "least": [[0]], "slot": pa.array([[]], pa.list_(pa.int32())),
                     "doc": pa.array([[]], pa.list_(pa.int32())), "score": pa.array([[]], pa.list_(pa.int64()))})
    unit = 10**9 // 1800
    right = pa.table({"docs": [[0, 1, 2], [3]], "tfs": [[1, 1, 1], [1]], "gain_slots": [[3], [3]],
                      "gains": [[10], [1]]})
    out = stage(left, right).to_pylist()[0]
    assert out["doc"] == [0, 1, 2] and out["score"] == [10 * unit] * 3
    assert out["top_scores"] == [10 * unit] * 2 and np.unique(out["slot"]).tolist() == [3]
