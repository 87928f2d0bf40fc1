import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from subtally.llm import simhash
from subtally.llm.components import components
from tests.llm.texts import HARD, mixed, prose


def brute_print(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(names, prints, radius=4):
    """Smallest name reachable over pairs within the radius, nulls last."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = {}
    for i, name in enumerate(names):
        groups.setdefault(find(i), []).append(name)
    return [min((n for n in groups[find(i)] if n is not None), default=None) for i in range(len(names))]


def test_fingerprints_are_exact(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 64)  # a text spans several slices
    texts = [*HARD, *mixed(6, 120), prose(6, 700)]
    found = simhash.fingerprints_of(pa.array(texts), 4).view(np.uint64)
    assert [int(x) for x in found] == [brute_print(t) for t in texts]
    assert len(simhash.fingerprints_of(pa.array([], pa.string()), 4)) == 0


@pytest.mark.parametrize("radius", range(0, 8))
def test_links_in_groups_connect_what_is_near(radius):
    rng = np.random.default_rng(radius)
    for _ in range(12):
        n = int(rng.integers(2, 300))
        base = rng.integers(0, 2**63, max(1, n // 10), np.uint64)
        fps = base[rng.integers(0, len(base), n)]
        for _ in range(6):
            fps = np.where(rng.random(n) < 0.5, fps ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)), fps)
        group = np.sort(rng.integers(0, 4, n))
        a, b = simhash.linked(fps, group, radius)
        assert (group[a] == group[b]).all() and (np.bitwise_count(fps[a] ^ fps[b]) <= radius).all()
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            want = brute_components(own.tolist(), [int(x) for x in fps[own]], radius)
            label = {int(i): int(i) for i in own}

            def find(i, label=label):
                while label[i] != i:
                    i = label[i]
                return i

            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                if group[x] == g:
                    x, y = find(x), find(y)
                    label[max(x, y)] = min(x, y)
            assert [find(int(i)) for i in own] == want


def near_copies(seed):
    rng = np.random.default_rng(seed)
    centre = int(rng.integers(0, 2**63))
    prints = [centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False)) for _ in range(150)]
    chain = [int(rng.integers(0, 2**63))]
    for _ in range(60):  # each within four bits of the one before, the ends far apart
        chain.append(chain[-1] ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
    return [*prints, *chain, *(int(x) for x in rng.integers(0, 2**63, 60)), 0, 0, centre]


@pytest.mark.parametrize("page", [8192, 16])
def test_components_equal_brute_force_also_in_paged_groups(spark, monkeypatch, page):
    monkeypatch.setattr(simhash, "PAGE", page)
    monkeypatch.setattr(simhash, "STRETCH", 64 if page == 16 else 1 << 17)
    prints = near_copies(page)
    names = [*range(500, 500 + len(prints) - 2), 7, None]
    rows = [(n, int(np.uint64(p).astype(np.int64)), "x") for n, p in zip(names, prints, strict=True)]
    frame = spark.createDataFrame(rows, "doc_id bigint, fp bigint, component string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(frame).collect())
    want = sorted((n is None, n or 0, c) for n, c in zip(names, brute_components(names, prints), strict=True))
    assert got == want


def test_whole_documents(documents):
    base = prose(8, 400)
    texts = [None, "", base, base.replace("w1", "v1", 1), base.upper(), prose(9, 300), base, *HARD]
    rows = [(i * 3, t, "clash") for i, t in enumerate(texts)] + [(None, base, "clash"), (6, base, "clash")]
    prints = simhash.fingerprints(documents(rows, "doc_id bigint, text string, fp string"), "doc_id")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(prints).collect())
    names = [r[0] for r in rows]
    want = brute_components(names, [brute_print(r[1]) for r in rows])
    assert got == sorted((n is None, n or 0, c) for n, c in zip(names, want, strict=True))


def test_empty_table(documents):
    prints = simhash.fingerprints(documents([]), "doc_id")
    assert simhash.near_duplicates(prints).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (2, 1), (1, 2)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_places_of_shingles_are_not_all_python_numbers_at_once():
    words = 600_000
    text = pa.array([" ".join(str(i % 977) for i in range(words))])
    tracemalloc.start()
    hashes, document = simhash.shingle_hashes(text, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hashes) == len(document) == words - 3
    assert peak < 115 * words  # 82 to 90 bytes a word; all places in lists made it 140 and more
    assert hashes[200_000] == xxhash.xxh64_intdigest(" ".join(str(i % 977) for i in range(200_000, 200_004)), simhash.SEED)
