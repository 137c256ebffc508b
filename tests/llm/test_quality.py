import numpy as np
import pytest

from tests.conftest import SF_CHECK
from tests.llm.helpers import edge_docs, empty_docs
from workbench.llm import quality as Q


def test_label_model_finds_the_classes_of_simulated_votes():
    """Votes drawn from known accuracies: as many right as with the true ones."""
    random = np.random.default_rng(1)
    n, fires = 20_000, 0.85
    truth = random.choice(6, n, p=[0.8, 0.05, 0.04, 0.04, 0.03, 0.04])
    v = np.full((n, Q.LABELLERS), Q.ABSTAIN)
    for j, fault in enumerate([1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5]):
        seen = np.where(truth == fault, random.random(n) < fires, random.random(n) < 0.01)
        v[:, j] = np.where(seen, fault, Q.CLEAN)
    patterns, counts = np.unique(Q.pattern(v.astype(np.int8)), return_counts=True)
    assert (Q.unpacked(Q.pattern(v.astype(np.int8))) == v).all()
    model = Q.fit_labels(Q.unpacked(patterns), counts.astype(float))
    assert abs(model.prior - np.bincount(truth) / n).max() < 0.02
    # three labellers look for toxic texts, two for each other fault
    assert abs(model.vote[8:11, 5, 5 + 1] - fires).max() < 0.05
    assert abs(model.vote[0][1][1 + 1] - fires) < 0.1
    true = np.full((Q.LABELLERS, 6, Q.DIGITS), 1e-9)
    for j, fault in enumerate([1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5]):
        true[j, :, fault + 1] = np.where(np.arange(6) == fault, fires, 0.01)
        true[j, :, Q.CLEAN + 1] = 1 - true[j, :, fault + 1]
    best = Q.LabelModel(np.bincount(truth) / n, true)
    right, possible = ((m.posterior(v).argmax(1) == truth).mean() for m in (model, best))
    assert right > possible - 0.005


def test_scorer_learns_a_planted_word():
    random = np.random.default_rng(2)
    rows = [np.unique(random.integers(0, 5000, 80)).astype(np.int32) for _ in range(1500)]
    target = np.array([float(7 in r or 9 in r) for r in rows])
    scorer = Q.fit_scorer(rows, target, epochs=15)
    first = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    p = scorer.probability(np.concatenate(rows), first)
    assert ((p > 0.5) == (target > 0.5)).mean() > 0.98


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_documents_against_labels_that_were_held_back(spark, share):
    """With all labels, and with three tenths of them kept back for the test."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = {r.doc_id: r for r in labels.collect()}
    known = labels.filter(f"pmod(hash(doc_id), 10) < {int(share * 10)}")
    held = set(rows) - ({r.doc_id for r in known.collect()} if share < 1 else set())
    got = {r.doc_id: r.kept for r in Q.classify(docs, known).collect()}
    assert len(got) == docs.count()
    good = [i for i in held if rows[i].quality == 1 and rows[i].toxic == 0]
    bad = [i for i in held if rows[i].quality == 0 or rows[i].toxic == 1]
    assert np.mean([got[i] for i in good]) > 0.98
    assert np.mean([not got[i] for i in bad]) > (0.9 if share == 1 else 0.7)


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (9, None, None), (13, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rows = Q.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r, d in zip(sorted(rows, key=str), range(99)):
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[4] | by_text[7] | by_text[8]) == 1  # null, empty, blank
    left = Q.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() <= docs.count()
    assert len(Q.classify(docs).collect()) == docs.count()  # no labels at all
    assert len(Q.classify(docs, labels.limit(0)).collect()) == docs.count()


def test_empty_table(spark):
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert Q.classify(empty_docs(spark), labels).count() == 0
    assert Q.keep_good(empty_docs(spark), labels).count() == 0
