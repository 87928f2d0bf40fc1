import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from subtally.llm import lexical
from tests.llm.texts import HARD, mixed, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, keep=10):
    """Every document scored for every item."""
    vectors = [(i, terms_of(t)) for i, t in docs]
    vectors = [(i, len(t), Counter(t)) for i, t in vectors if t]
    total, number = sum(n for _, n, _ in vectors), len(vectors)
    df = Counter(t for _, _, tf in vectors for t in tf)
    rows = []
    for item, text in items:
        own = set(terms_of(text))
        found = []
        for doc, n, tf in vectors:
            m = 10 + (90 * n * number) // total
            score = 0
            for t in own & tf.keys():
                score += floor(1000 * log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        rows += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found, key=lambda f: f[:3])[:keep], 1)]
    return sorted(rows, key=str)


def corpus():
    rng = random.Random(12)
    docs = [(i, prose(i, rng.randint(1, 120), 80)) for i in range(150)]
    docs += [(200 + i, t) for i, t in enumerate([None, *HARD, *mixed(6, 60)])]
    docs += [(300 + i, "w1 w2 w3 Ünï w4") for i in range(60)]  # copies: ties by id
    docs += [(None, "w1 w2 w3 Ünï w4"), (None, "w5"), (7, "again w9"), (7, "again w9")]
    items = [(i, prose(100 + i, 12, 90)) for i in range(12)] + [(50, "w1 w2 W3 Ünï"), (51, ""), (52, None), (53, "nobody has this")]
    return docs, items + [(None, "AGAIN w9 nobody"), (50, "w1 w2 W3 Ünï"), (60, "a Be é 一 12 😀 token"), (61, "x" * 5000 + " word")]


@pytest.mark.parametrize("limits", [(4096, 16, 50_000), (7, 2, 20), (50, 1, 50_000)])
def test_the_best_are_those_of_all_scores(documents, monkeypatch, limits):
    monkeypatch.setattr(lexical, "DOCUMENTS", limits[0])
    monkeypatch.setattr(lexical, "LEAF", limits[1])
    docs, items = corpus()
    table = documents([(i, t, 1) for i, t in docs], "doc_id bigint, text string, terms int")
    asked = documents([(i, t, "n") for i, t in items], "item_id bigint, text string, counts string", "items")
    found = lexical.top_documents(table, asked, block_terms=limits[2])
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str) == brute(docs, items)


def test_empty_tables(documents):
    empty, some = documents([], name="none"), documents([(1, "a b")], name="some")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert lexical.top_documents(empty, items).count() == 0
    assert lexical.top_documents(some, items.limit(0)).count() == 0


def test_terms():
    starts, found = lexical.term_lists(pa.array(["A-b_c 1é2", "", "\u0000x\u007f", "ÄÉ É"]))
    assert found.to_pylist() == ["a", "b", "c", "1é2", "x", "ÄÉ", "É"]
    assert starts.tolist() == [0, 4, 4, 5, 7]


def test_a_trie_shares_paths_and_bounds_leave_documents_out(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", 16)
    rng = np.random.default_rng(3)
    counts = (rng.random((2000, 40)) < 0.9 / np.arange(1, 41)).astype(np.int32) * rng.integers(1, 5, (2000, 40), np.int32)
    m = rng.integers(20, 300, 2000)
    trie = lexical.Trie(counts, m, np.arange(2000))
    for node, below in enumerate(trie.children):
        low, high = trie.range[node]
        assert (trie.most[node] == trie.counts[low:high].max(axis=0)).all() and trie.least_m[node] == trie.m[low:high].min()
        parts = sorted(trie.range[c] for c in below)
        assert not below or [low, *(b for _, b in parts)] == [*(a for a, _ in parts), high]
    columns, weights = np.array([1, 7, 20, 33]), np.array([10, 900, 2500, 4000])
    best = lexical.Best(10)
    scored = trie.search(columns, weights, best)
    exact = sorted(zip((-lexical.scores(counts[:, columns], m, weights)).tolist(), range(2000), strict=True))[:10]
    assert sorted((-s, -x) for s, x in best.heap) == exact
    assert scored < 500
