"""Exact and approximate search against brute force."""

import numpy as np
import pytest

from parceltrail.llm import rp_forest, va_file

SCHEMA = "vec_id long, embedding array<float>, label int, score string, dims string"


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in rows], SCHEMA).repartition(3)

    return make


def good(rows, zero=True):
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v):
            continue
        if zero or any(v):
            yield i, np.array(np.float32(v), dtype=np.float64)


def expected_products(rows, every, k):
    rows = [(i, [int(c) for c in np.floor(256 * v)]) for i, v in good(rows)]
    out = []
    for q, x in rows:
        if q % every == 0:
            best = sorted(
                (-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(x) == len(y)
            )[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


AWKWARD = [
    (0, [1.0, 2.0, 3.0]),
    (1, [1.0, 2.0, 3.0]),
    (2, [1.0, 2.0, 3.0]),
    (3, None),
    (4, []),
    (5, [1.0, None, 2.0]),
    (6, [float("nan"), 1.0, 2.0]),
    (7, [float("inf"), 1.0, 2.0]),
    (8, [0.0, 0.0, 0.0]),
    (None, [5.0, 5.0, 5.0]),
    (50, [-1.0, 0.5, 0.25]),
    (100, [0.1, 0.2]),
    (101, [0.1, 0.2]),
    (102, [3.0, 0.1]),
    (9, [1.5, 2.0, 3.0]),
]


def test_top_k_on_awkward_rows(vectors):
    found = va_file.top_k(vectors(AWKWARD), every=50, k=5).collect()
    assert sorted(map(tuple, found)) == expected_products(AWKWARD, 50, 5)


def test_top_k_in_many_blocks(vectors):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # many copies, so many ties
    found = va_file.top_k(vectors(rows), every=10, k=7, rows=60, queries=9).collect()
    assert sorted(map(tuple, found)) == expected_products(rows, 10, 7)


def test_top_k_of_large_components(vectors):
    rows = [(i, [1e5 * (i + 1), -2e5, 3.0 * i]) for i in range(20)]
    rows[3] = (3, [5e5, 1e6, 1e6])
    assert sorted(map(tuple, va_file.top_k(vectors(rows), 5, 3).collect())) == expected_products(rows, 5, 3)


def test_few_candidates_and_empty_tables(vectors):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    assert sorted(map(tuple, va_file.top_k(vectors(rows)).collect())) == expected_products(rows, 50, 5)
    for search in (va_file.digest, rp_forest.digest):
        assert search(vectors([])).count() == 0
        assert search(vectors([(1, [1.0]), (3, [2.0])])).count() == 0


def test_bounds_are_never_exceeded():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.standard_normal((300, 6)))
    x[:, 2] = 7  # a dimension without spread
    q = np.floor(256 * rng.standard_normal((40, 6)))
    cells, bounds = va_file.approximate(x)
    assert (va_file.upper_bounds(q, cells, bounds) >= q @ x.T).all()


def expected_nearest(rows, every, k):
    rows = list(good(rows, zero=False))
    out = {}
    for q, x in rows:
        if q % every == 0:
            out[q] = sorted((np.sqrt(((x - y) ** 2).sum()), i) for i, y in rows if i != q and len(x) == len(y))[:k]
    return out


def test_nearest_on_awkward_rows(vectors):
    found = rp_forest.nearest(vectors(AWKWARD), every=50, k=10).collect()
    expected = expected_nearest(AWKWARD, 50, 10)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(
        (q, n, i) for q, best in expected.items() for n, (_, i) in enumerate(best, 1)
    )
    assert all(r.score == expected[r.query_id][r["rank"] - 1][0] for r in found)


def test_recall_and_true_distances(vectors):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist()) for i in range(4000)]
    rows += [(4000 + i, rows[0][1]) for i in range(200)]
    found = rp_forest.nearest(vectors(rows), every=100, k=10, rows=3000).collect()
    expected = expected_nearest(rows, 100, 10)
    by_id = {i: v for i, v in good(rows)}
    hits = sum(r.vec_id in {i for _, i in expected[r.query_id]} for r in found)
    assert len(found) == 10 * len(expected) and hits >= 0.9 * len(found)
    assert all(r.score == np.sqrt(((by_id[r.query_id] - by_id[r.vec_id]) ** 2).sum()) for r in found)
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0] == list(range(4000, 4010))


def test_every_row_is_in_every_tree():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.standard_normal((500, 5)), np.ones((300, 5))])
    forest = rp_forest.Forest(x, trees=3, leaf=20)
    rows = np.concatenate(forest.leaves)
    assert np.bincount(rows, minlength=800).tolist() == [3] * 800
    assert sorted(map(len, forest.leaves))[-3:] >= [300] * 3  # equal vectors stay together
