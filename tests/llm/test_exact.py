import hashlib
import re
from collections import defaultdict

import pytest

from tests.llm.helpers import LONG, edge_docs, edge_rows, empty_docs
from workbench.llm import exact


def plain(rows):
    """keep_id, size and digest of each (doc_id, text)."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm):
        groups[t].append(i)
    first = {t: min((i is None, i) for i in ids)[1] for t, ids in groups.items()}
    return sorted(((i, first[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
                   for (i, _), t in zip(rows, norm)), key=str)


@pytest.mark.parametrize("options", [
    {}, {"chunk": 64, "spread": 1000},
    # a fingerprint of three values at most: texts of one length collide
    {"primes": (3, 2), "chunk": 50_000}])
def test_edges_equal_plain_version(spark, options):
    got = exact.find_copies(edge_docs(spark), **options).collect()
    rows = [r[:2] for r in edge_rows()]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_drop_copies_keeps_columns_and_one_row_of_each_class(spark):
    docs = edge_docs(spark)
    got = exact.drop_copies(docs)
    assert got.columns == docs.columns
    left = got.collect()
    assert len(left) == len({re.sub(r"\s+", " ", t or "") for _, t in (r[:2] for r in edge_rows())})
    assert sum(r.doc_id == 13 and r.text == "a" for r in left) == 1
    assert [r.doc_id for r in left if r.text == LONG] == [2]


def test_chunks_compose(spark):
    rows = spark.createDataFrame([(1, LONG), (2, LONG[:-1] + "X"), (3, "")], "r bigint, text string")
    def run(**o):
        return {r.r: (r.f1, r.f2) for r in exact.fingerprints(rows, **o).collect()}
    whole = run(chunk=1 << 16, spread=1 << 30)
    assert run(chunk=1 << 16, spread=10) == whole == run(chunk=997, spread=1 << 30)
    assert len(set(whole.values())) == 3
    value = 0
    for b in LONG.encode():
        value = (value * exact.BASES[0] + b) % exact.PRIMES[0]
    assert whole[1][0] == value


def test_empty_table(spark):
    assert exact.find_copies(empty_docs(spark)).count() == 0
    assert exact.drop_copies(empty_docs(spark)).count() == 0
