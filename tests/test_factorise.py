"""The truncated decomposition against numpy's on whole matrices."""

import numpy as np
import pytest

from workbench.operators import factorise
from workbench.plans import catalog

SF = "/root/testdata/sf0.001"


def long_form(spark, a, parts):
    rows = [(f"r{i}", int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))]
    return spark.createDataFrame(rows, "name string, slot int, weight double").repartition(parts)


def read(svd, n_rows):
    values = sorted(map(tuple, svd.values.collect()))
    left = {r.name: r.u for r in svd.left.collect()}
    right = [r.v for r in svd.right.orderBy("slot").collect()]
    return np.array([v[1] for v in values]), left, np.array(right)


def matrix(seed, n=60, m=45):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random((n, m)) < 0.15, rng.gamma(1.0, 2.0, (n, m)), 0)
    a[0] = a[:, 0] = 0  # an empty row and an empty column
    return a


def test_equals_numpy(spark):
    a = matrix(1)
    sigma, left, right = read(factorise.truncated_svd(long_form(spark, a, 4), "name", "slot", "weight", 45, 6), 60)
    u, s, vt = np.linalg.svd(a)
    assert np.allclose(sigma, s[:6], rtol=1e-10)
    assert "r0" not in left and np.allclose(right[0], 0)
    for k in range(6):
        v = vt[k] * np.sign(vt[k][np.abs(vt[k]).argmax()])
        assert np.allclose(right[:, k], v, atol=1e-6)
        own = u[:, k] * np.sign(vt[k][np.abs(vt[k]).argmax()])
        assert all(abs(x[k] - own[int(name[1:])]) < 1e-6 for name, x in left.items())


def test_layout_does_not_matter(spark):
    a = matrix(2)
    results = [read(factorise.truncated_svd(long_form(spark, a, p), "name", "slot", "weight", 45, 5), 60)
               for p in (1, 8, 32)]
    for sigma, left, right in results[1:]:
        assert np.allclose(sigma, results[0][0], rtol=1e-12)
        assert np.allclose(right, results[0][2], atol=1e-9)
        assert all(np.allclose(left[k], results[0][1][k], atol=1e-9) for k in left)


@pytest.mark.parametrize("rank", [0, 1, 3])
def test_low_rank_and_empty(spark, rank):
    rng = np.random.default_rng(rank)
    a = np.round(rng.random((20, rank)), 2) @ np.round(rng.random((rank, 12)), 2)
    sigma, left, _ = read(factorise.truncated_svd(long_form(spark, a, 3), "name", "slot", "weight", 12, 5), 20)
    assert len(sigma) == rank and np.allclose(sigma, np.linalg.svd(a)[1][:rank])
    assert len(left) == (20 if rank else 0)


def test_repeated_entries_add_up(spark):
    rows = [("r", 0, 1.0), ("r", 0, 2.0), ("s", 1, 4.0), ("t", 2, 1.0), ("t", 2, -1.0)]
    df = spark.createDataFrame(rows, "name string, slot int, weight double")
    sigma, left, _ = read(factorise.truncated_svd(df, "name", "slot", "weight", 3, 3), 3)
    assert np.allclose(sigma, [4, 3]) and set(left) == {"r", "s"}


def test_equal_values_and_slow_decay():
    """Many eigenvalues close together: steps and restarts still settle."""
    theta = np.concatenate(([5.0, 5.0, 4.99], np.linspace(4.5, 1, 300)))
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((303, 303)))[0]
    m = q @ np.diag(theta) @ q.T
    found, v, residual = factorise.top_eigenvectors(lambda x: m @ x, 303, 5)
    assert np.allclose(found, theta[:5], rtol=1e-9) and residual.max() <= 1e-9
    assert np.allclose(v.T @ v, np.eye(5), atol=1e-9)


def test_columns_have_a_bound(spark):
    with pytest.raises(ValueError):
        factorise.truncated_svd(None, "a", "b", "c", factorise.MAX_COLUMNS + 1, 2)


def test_documents_equal_numpy(spark):
    """The TF-IDF matrix of the small documents, whole: values to 1e-6 of numpy's."""
    svd, weights = catalog._term_svd(spark, SF)
    rows = weights.select("doc_id", "term_id", "tfidf").toPandas()
    docs = {d: i for i, d in enumerate(sorted(rows.doc_id.unique()))}
    a = np.zeros((len(docs), rows.term_id.max() + 1))
    a[rows.doc_id.map(docs), rows.term_id] = rows.tfidf
    s = np.linalg.svd(a, compute_uv=False)
    got = [r.sigma for r in svd.values.orderBy("component").collect()]
    assert np.allclose(got, s[:10], rtol=1e-6)


def sparse_rows(rng, rows, n):
    """(columns, values, first entries) of random rows, the last one holding every column."""
    at = [np.sort(rng.choice(n, int(rng.integers(1, 150)), replace=False)) for _ in range(rows)] + [np.arange(n)]
    return (np.concatenate(at).astype(np.int32), rng.normal(size=sum(map(len, at))),
            np.concatenate(([0], np.cumsum([len(x) for x in at]))))


@pytest.mark.parametrize("n", [700, 1 << 16, (1 << 16) + 1])
def test_products_of_sparse_rows_and_their_transpose(n):
    """Columns beyond 16 bits, rows longer than a piece, and more entries than one holds."""
    rng = np.random.default_rng(4)
    at, value, ends = sparse_rows(rng, 200, n)
    v, rows = rng.normal(size=(n, 3)), np.repeat(np.arange(201), np.diff(ends))
    y = np.zeros((201, 3))
    np.add.at(y, rows, value[:, None] * v[at])
    assert np.allclose(factorise._times(at, value, ends, v), y, rtol=1e-12, atol=1e-12)
    back, out = np.zeros((n, 3)), np.zeros((n, 3))
    np.add.at(back, at, value[:, None] * y[rows])
    order, begin, owner = factorise._transposed(at, ends, n)
    out[at[order[begin[:-1]]]] += factorise._times(owner, value[order], begin, y)
    assert np.allclose(out, back, rtol=1e-12, atol=1e-12)
    with pytest.raises(IndexError):
        factorise._times(at, value, ends, v[:-1])


def test_products_stay_small():
    """The products of 40,000 entries with a matrix of 20 columns, 6 MB, were formed at once."""
    import tracemalloc
    at, value, ends = sparse_rows(np.random.default_rng(4), 500, 300)
    v = np.ones((300, 20))
    tracemalloc.start()
    factorise._times(at, value, ends, v)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(at) > 30_000 and peak < 1_500_000
