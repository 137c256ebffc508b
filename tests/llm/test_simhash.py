import random

import numpy as np
import pytest
import xxhash

from tests.conftest import SF_SMALL
from tests.llm.helpers import Groups, edge_docs, empty_docs, words
from workbench.llm import simhash


def print_of(text):
    w = [x.encode() for x in words(text)]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain(rows):
    prints = [print_of(t) for _, t in rows]
    distinct = sorted(set(prints))
    g = Groups(distinct)
    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 4:
                g.join(a, b)
    first = {}
    for (i, _), p in zip(rows, prints):
        key = (i is None, i)
        r = g.root(p)
        first[r] = min(first.get(r, key), key)
    return sorted(((i, f"{p:016x}", first[g.root(p)][1]) for (i, _), p in zip(rows, prints)), key=str)


def run(docs, **options):
    return sorted(map(tuple, simhash.near_duplicates(docs, **options).collect()), key=str)


@pytest.mark.parametrize("tree_size", [2048, 2])
def test_documents_equal_plain_version(spark, tree_size):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(docs, tree_size=tree_size) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark):
    docs = edge_docs(spark)
    expected = plain([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    assert run(docs) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # two of the rows with doc_id 13 say the same, the third does not
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 12, 13, 13]


def test_empty_table(spark):
    assert run(empty_docs(spark)) == [] and simhash.keep_one(empty_docs(spark)).count() == 0


def close_values(n):
    """Clusters of values a few bits apart, and far ones."""
    random.seed(8)
    out = set()
    for _ in range(12):
        x = random.getrandbits(64)
        for _ in range(n):
            out.add(x)
            for _ in range(random.randint(1, 3)):
                x ^= 1 << random.randrange(64)
    return sorted(out | {random.getrandbits(64) for _ in range(200)})


def test_tree_finds_all_within_radius():
    values = close_values(20)
    tree = simhash.Tree()
    for x in values:
        tree.add(x)
    for x in values[::7]:
        near = {tree.value[k] for k in tree.near(x, 4)}
        assert near == {y for y in values if (x ^ y).bit_count() <= 4}


@pytest.mark.parametrize("tree_size", [2048, 3])
def test_links_connect_exactly_the_close(spark, tree_size):
    values = close_values(25)
    signed = [int(x) for x in np.array(values, np.uint64).view(np.int64)]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got, full = simhash.links(nodes, tree_size=tree_size).collect(), (1 << 64) - 1
    a, b = Groups(values), Groups(values)
    for r in got:
        assert ((r.a & full) ^ (r.b & full)).bit_count() <= 4
        a.join(r.a & full, r.b & full)
    for i, x in enumerate(values):
        for y in values[:i]:
            if (x ^ y).bit_count() <= 4:
                b.join(x, y)
    assert [a.root(x) for x in values] == [b.root(x) for x in values]


@pytest.mark.parametrize("n", [10, 10**6, 2 * 10**8, 10**10])
def test_masks_lose_no_pair(n):
    masks = simhash._masks(4, n)
    random.seed(n)
    for _ in range(300):
        d = sum(1 << b for b in random.sample(range(64), 4))
        assert any(d & m == 0 for m in masks)
