import math

import numpy as np
import pytest

from subtally.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>, score string"


def brute(rows, k=5, every=50):
    sound = []
    for vec_id, x, _ in rows:
        if vec_id is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            sound.append((vec_id, tuple(math.floor(256 * c) for c in x)))
    found = set()
    for query_id, q in {s for s in sound if s[0] % every == 0}:
        scores = [(-sum(a * b for a, b in zip(q, x, strict=False)), vec_id) for vec_id, x in sound if vec_id != query_id]
        found |= {(query_id, rank + 1, vec_id, -score) for rank, (score, vec_id) in enumerate(sorted(scores)[:k])}
    return found


def check(documents, rows, **more):
    found = topk.top_k(documents(rows, SCHEMA, "vectors"), **more).collect()
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found]
    want = brute(rows, **more)
    assert set(got) == want and len(got) == len(want)


def vectors(seed, n, clusters=20, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    x = centres[rng.integers(0, clusters, n)] * rng.uniform(0.2, 2, (n, 1)) + rng.normal(0, 0.05, (n, dim))
    return [(i, v.tolist(), "x") for i, v in enumerate(x)]


def test_clustered_vectors_in_many_trees_and_pages(documents, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 300)
    monkeypatch.setattr(topk, "PAGE", 16)
    monkeypatch.setattr(topk, "CELLS", 8)
    monkeypatch.setattr(topk, "BLOCK", 17)
    check(documents, vectors(1, 2500))


def test_a_hot_group_of_equal_vectors_ties_and_strange_rows(documents, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 64)
    monkeypatch.setattr(topk, "PAGE", 8)
    rows = [(i, [0.5, -0.25, 1.0], "copy") for i in range(400)] + [(1000 + i, [0.0, 0.0, 0.0], "zero") for i in range(120)]
    rows += [(2000, None, "x"), (2050, [None, 1.0, 1.0], "x"), (2100, [float("nan"), 1.0, 1.0], "x"), (2150, [float("inf"), 1.0, 1.0], "x"), (None, [9.0, 9.0, 9.0], "x")]
    rows += [(2200, [], "empty"), (2250, [1.0], "short"), (2300, [1.0, 2.0, 3.0, 4.0], "long"), (2350, [-0.0001, 0.0039, 0.0], "x")]
    check(documents, rows)


def test_few_rows(documents):
    check(documents, [(0, [1.0, 2.0], "x"), (50, [1.0, 2.0], "x"), (3, [2.0, 1.0], "x")])
    assert topk.top_k(documents([], SCHEMA, "none")).count() == 0
    assert topk.top_k(documents([(0, None, "x")], SCHEMA, "null")).count() == 0
    assert topk.top_k(documents([(0, [1.0], "x")], SCHEMA, "one")).count() == 0


def test_large_numbers_stay_exact(documents):
    rng = np.random.default_rng(4)
    check(documents, [(i, (rng.normal(size=8) * 3e5).tolist(), "x") for i in range(300)])


def test_numbers_beyond_a_long_give_its_limit(documents):
    rows = [(0, [1e200, 1.0], "x"), (1, [1e200, 0.0], "x"), (2, [-1e200, 0.0], "x")]
    found = {r.vec_id: r.score for r in topk.top_k(documents(rows, SCHEMA, "vectors")).collect()}
    assert found == {1: 2**63 - 1, 2: -(2**63 - 1)}


@pytest.mark.parametrize("k,every", [(1, 50), (3, 7), (40, 100)])
def test_other_sizes(documents, k, every):
    check(documents, vectors(k, 300), k=k, every=every)


def test_repeated_rows(documents):
    rows = vectors(5, 200)
    found = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(documents(rows + rows[51:53], SCHEMA, "vectors")).collect()}
    assert found == brute(rows + rows[51:53])


def test_pages_far_away_are_not_computed(monkeypatch):
    """Stored distances rule out most pages of well separated clusters before any product is made for them."""
    rng = np.random.default_rng(6)
    x = np.rint(np.repeat(rng.normal(size=(64, 32)) * 1000, 128, axis=0) + rng.normal(size=(8192, 32)) * 5)
    unit = np.abs(x).max()
    space = topk.Space(32, unit, ((x / unit) ** 2).sum(1).max())
    tree = topk.build(np.arange(len(x)), x, space)
    made = []
    products = topk.products
    monkeypatch.setattr(topk, "products", lambda q, e: made.append(len(q) * len(e)) or products(q, e))
    queries = x[::128]
    best = topk.Best(len(queries), 5)
    topk.search(tree, np.arange(0, len(x), 128), queries, space, best)
    assert sum(made) < len(queries) * len(x) / 4
    scores = queries @ x.T
    scores[np.arange(len(queries)), np.arange(0, len(x), 128)] = -1e18
    assert (best.scores == -np.sort(-scores, axis=1)[:, :5]).all()
