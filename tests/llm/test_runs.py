import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.conftest import SF_SMALL
from tests.llm.helpers import edge_docs, edge_rows, empty_docs
from workbench.llm import queries, runs


def plain_runs(words, least=24, repeats=3):
    """All runs (start, length, period) by comparing every word with that one period on."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        start = 0
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                continue
            length = i - start + q
            if i > start and length >= max(least, repeats * q):
                part = words[start:start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, length, q))
            start = i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The row of the query for one document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("page", [1, 7, 50, 1 << 16])
def test_runs_equal_plain_version(page):
    rng = random.Random(page)
    for _ in range(120):
        words = []
        for _ in range(rng.randint(1, 6)):
            letters = rng.choice([1, 2, 5, 50])
            if rng.random() < 0.3:
                words += [rng.randint(0, letters) for _ in range(rng.randint(0, 60))]
            else:
                unit = [rng.randint(0, letters) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 33]))]
                words += (unit * 8)[:rng.randint(1, 7) * len(unit) + rng.randint(0, len(unit))]
            if rng.random() < 0.2:
                words = words * rng.randint(1, 4)
        words = words[:400]
        assert runs.runs_of(np.array(words, np.int32), page=page) == plain_runs(words)


def test_other_bounds():
    words = [1, 2, 3] * 12 + [9] + [5] * 40
    a = np.array(words, np.int32)
    assert runs.runs_of(a, least=30, repeats=4) == plain_runs(words, 30, 4) == [(0, 36, 3), (37, 40, 1)]
    with pytest.raises(ValueError):
        runs.Catchers(least=10)


def test_runs_go_on_over_pages_and_within_bounds_of_work():
    """Highly periodic texts, with nested runs, in time that grows like the text."""
    cycle = np.tile(np.append(np.zeros(24, np.int32), 1), 8_000)
    assert len(runs.runs_of(cycle)) == 8_001
    assert runs.runs_of(np.zeros(400_000, np.int32)) == [(0, 400_000, 1)]
    long = (np.arange(300_000) % 5_001 == 0).astype(np.int32)
    assert runs.runs_of(long, page=1_000)[0] == (0, 300_000, 5_001)


def test_query_equals_plain_version(spark):
    table = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    want = [plain_row(r["doc_id"], r["text"]) for r in table if len(r["text"] or "") < 6_000]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op11_word_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(table)
    assert [got[w[0]] for w in want] == want
    assert sum(w[1] for w in want) > 5


def test_edges(spark):
    rows = runs.find_runs(edge_docs(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted(
        (x[0] is None, x[0] or 0) for x in edge_rows())
    for r in rows:
        if r.doc_id in (2, 11):  # "word0 and word1 and ...", 977 words long
            assert [tuple(x) for x in r.runs] == [(0, 80_000, 1_954)]
            assert r.collapsed.split()[-1] == ("and" if r.doc_id == 2 else "end")
        else:
            assert r.runs == []
        if r.doc_id in (4, 7, 8):
            assert (r.n_words, r.collapsed) == (0, "")
    assert runs.find_runs(empty_docs(spark)).count() == 0


def test_long_text_in_pieces():
    unit = b"\xc3\xa4 b\x0bc\t\td "
    data = unit * 400_000
    assert b"".join(b" ".join(p) + b" " for p in runs.pieces(data, 1_000)).split() == data.split()
    words = runs.word_numbers(data)
    assert runs.runs_of(words) == [(0, 1_600_000, 4)]
    assert runs.collapse(data, runs.kept_words(len(words), runs.runs_of(words))) == b"\xc3\xa4 b c d"
