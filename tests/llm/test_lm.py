import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_CHECK
from tests.llm.helpers import edge_docs, empty_docs, words
from workbench.llm import lm


def plain(rows):
    """(doc_id, held_out, n_tokens, n_known, N, base) of each row."""
    tokens = [[*words(t), ""] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for x, h in zip(tokens, held) if not h for w in x)
    n = sum(c.values())
    return [(i, h, len(x), sum(c[w] > 0 for w in x), n,
             sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in x))
            for (i, _), x, h in zip(rows, tokens, held)]


def check(docs, **options):
    got = lm.fold_scores(docs, **options).collect()
    expected = plain([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    order = lambda r: (str(r[0]), r[2], round(r[5], 4))
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=order), sorted(expected, key=order)):
        assert tuple(a)[:5] == b[:5] and a.base_score == pytest.approx(b[5], rel=1e-9)
        assert a.score < 0
    return got


@pytest.mark.parametrize("head", [lm.HEAD, 2_100])
def test_base_is_exact_and_the_model_beats_it_on_held_out_texts(spark, head):
    got = check(spark.read.parquet(f"{SF_CHECK}/documents.parquet").repartition(3), head=head)
    held = [r for r in got if r.held_out]
    assert len(held) > 100
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark):
    got = check(edge_docs(spark), vocabulary=20, rounds=2)
    scores = {}
    for r in got:
        scores.setdefault((r.doc_id, r.n_tokens), set()).add(round(r.score, 6))
    assert all(len(s) == 1 for k, s in scores.items() if k[0] in (2, 4))


def test_empty_table_and_no_training_rows(spark):
    assert lm.fold_scores(empty_docs(spark)).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = spark.createDataFrame([(i, "some words here") for i in held[:5]], "doc_id int, text string")
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in lm.fold_scores(docs).collect())


def test_probabilities_are_normalised_and_equal_the_plain_softmax():
    random = np.random.default_rng(1)
    n, d = 40, 6
    p = lm.Parameters(*(random.normal(0, 1, (n, d)).astype(np.float32) for _ in range(3)),
                      random.normal(0, 1, n).astype(np.float32))
    tables = lm.Tables.of(p)
    every = np.arange(n)
    for a, b in ((0, 0), (3, 17), (39, 1)):
        got = 10 ** tables.log10(np.full(n, a), np.full(n, b), every)
        s = (p.one[a] + p.two[b]) @ p.target.T + p.bias
        expected = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        assert abs(got.sum() - 1) < 1e-4 and np.allclose(got, expected, rtol=1e-3)


def test_contexts_stay_inside_a_text():
    one, two = lm.contexts(np.array([5, 6, 0, 7, 0, 0, 8]))
    assert one.tolist() == [0, 5, 6, 0, 7, 0, 0] and two.tolist() == [0, 0, 5, 0, 0, 0, 0]


def test_training_learns_a_fixed_order():
    sequence = np.tile([2, 3, 4, 5, 0], 4000)
    share = (np.bincount(sequence, minlength=6) + 1.0) / (len(sequence) + 6)
    random = np.random.default_rng(1)
    p = lm.Parameters(*(random.normal(0, 0.1, (6, 4)).astype(np.float32) for _ in range(3)),
                      np.log(share).astype(np.float32))
    square = [np.ones(x.shape, np.float32) for x in p[:3]]
    for _ in range(5):
        p = lm.train(p, sequence, share, square, random)
    one, two = lm.contexts(sequence)
    assert lm.Tables.of(p).log10(one, two, sequence).mean() > np.log10(share[sequence]).mean() + 0.4
