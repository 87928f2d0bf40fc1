import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from subtally.llm import alignment
from subtally.llm.packing import byte_of_symbol
from tests.llm.texts import HARD, mixed, prose

BYTE, PIECE = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


def tokens(text, library, pieces, names):
    """[(id, bytes)] of both vocabularies, straight from the libraries on the whole text."""
    a = library.encode(" " + text, add_special_tokens=False).ids
    b = pieces.encode(text)
    first = [(i, bytes(byte_of_symbol()[c] for c in names[i])) for i in a]
    second = []
    for i in b:
        piece = pieces.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
    return first, second


def spans(found):
    at, result = 0, []
    for i, own in found:
        result.append((i, at, at + len(own)))
        at += len(own)
    return result


def brute(texts):
    """Every column by comparing each token of A with each of B."""
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    names = {i: t for t, i in library.get_vocab().items()}
    pieces = SentencePieceProcessor(model_file=PIECE)
    own, linked = [], Counter()
    for text in texts:
        a, b = tokens(text, library, pieces, names) if text else ([], [])
        if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
            own.append(([], [], [], ""))
            continue
        a, b = spans(a), spans(b)
        links = []
        for i, s, e in a:
            links += [(i, j) for j, t, f in b if t < e and s < f]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for low, high in zip([0, *ends[:-1]], ends, strict=True):
            sides = [",".join(str(i) for i, _, e in side if low < e <= high) for side in (a, b)]
            groups.append("|".join(sides))
        own.append((a, b, links, ";".join(groups)))
        linked.update(links)
    best = {}
    for (_, j), n in linked.items():
        best[j] = max(best.get(j, 0), n)
    rows = []
    for a, b, links, groups in own:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_best = sum(linked[x] == best[x[1]] for x in links)
        rows.append((len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), n_best, sum(linked[x] for x in links), digest))
    return rows


@pytest.fixture(scope="module")
def corpus():
    texts = [None, *[x for x in HARD if len(x) < 4000], "word " * 60, "z" * 300, *mixed(5, 60), prose(5, 300), prose(5, 300), "一二三 一二三" * 20]
    return [*texts, "copy of this", "copy of this", "copy of this", "<0x41> <unk> [INST]"]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_measures_are_those_of_all_token_pairs(documents, corpus, monkeypatch, most):
    """Both ways of joining the pair counts."""
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", most)
    rows = [(i, t, "x", 7) for i, t in enumerate(corpus)] + [(None, corpus[-1], "y", 8), (0, None, "again", 9)]
    docs = documents(rows, "doc_id bigint, text string, pairs string, copies bigint")
    found = alignment.aligned_documents(docs, BYTE, PIECE)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = sorted((-1 if r.doc_id is None else r.doc_id, *(r[c] for c in columns)) for r in found.collect())
    want = sorted((-1 if r[0] is None else r[0], *x) for r, x in zip(rows, brute([r[1] for r in rows]), strict=True))
    assert got == want


def test_words_and_whole_texts_agree():
    with open(BYTE, encoding="utf-8") as file:
        aligner = alignment.Aligner(file.read(), alignment.read_model(PIECE))
    rng = random.Random(8)
    texts = [x for x in mixed(9, 300) if x] + [prose(9, 200), " ".join("q" * rng.randint(1, 900) for _ in range(20)), "x ▁ y"]
    alone = aligner.align(texts, True)
    for k, row in enumerate(aligner.batch(pa.array(texts))):
        links = alone.links[alone.links_at[k] : alone.links_at[k + 1]]
        pairs, times = np.unique(links, return_counts=True)
        assert row[:3] == tuple(alone.n[k]) and row[3] == bytes(alone.groups[alone.groups_at[k] : alone.groups_at[k + 1]])[:-1]
        assert (row[4] == pairs).all() and (row[5] == times).all()


def test_groups_can_be_kept(documents):
    row = alignment.aligned_documents(documents([(1, "hello there")]), BYTE, PIECE, keep_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.n_groups == row.groups.count(";") + 1


def test_a_hot_key_is_joined_by_broadcast(spark):
    left = spark.range(5000).selectExpr("id AS n", "if(id % 3 = 0, 1, id) AS k")
    right = left.groupBy("k").count().withColumnRenamed("count", "n_rows").selectExpr("k", "n_rows", "k * 2 AS twice")
    found = alignment.joined_by(left, right.filter("k <> 5"), "k", "n_rows", 5000)
    assert found.columns == ["n", "k", "twice"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(
        (r.n, r.k, None if r.k == 5 else r.k * 2) for r in left.collect()
    )


def test_an_empty_table(documents):
    assert alignment.aligned_documents(documents([]), BYTE, PIECE).count() == 0
