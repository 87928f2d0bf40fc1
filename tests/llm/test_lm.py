import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtally.llm import lm
from subtally.llm.common import id_crc
from subtally.llm.queries import op3_lm_scoring
from tests.llm.texts import HARD, mixed, prose


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def crc(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode())


def brute(rows, trained, learned):
    """Scores by dictionaries, EM over every single token."""
    own = [(i, tokens(t), trained(i), learned(i)) for i, t in rows]

    def counts(texts):
        words, contexts, pairs = Counter(), Counter(), Counter()
        for t in texts:
            words.update(t)
            contexts.update(["start", *t[:-1]])
            pairs.update(zip(["start", *t[:-1]], t, strict=True))
        return words, contexts, pairs

    words, contexts, pairs = counts([t for _, t, a, _ in own if a])
    kept_words, kept_contexts, kept_pairs = counts([t for _, t, a, b in own if a and not b])
    total, distinct, kept_total = sum(words.values()), len(words), sum(kept_words.values())

    def level(n):
        return min(int(math.log2(n)) + 1, lm.BUCKETS - 1) if n else 0

    seen = Counter()
    for _, t, a, b in own:
        if a and b:
            for before, token in zip(["start", *t[:-1]], t, strict=True):
                c = kept_contexts[before]
                pair = kept_pairs[before, token] / c if c else 0.0
                seen[level(c), pair * (distinct + 1), kept_words[token] / max(kept_total, 1) * (distinct + 1)] += 1
    ratio = np.array([(p, w, 1.0) for _, p, w in seen]).reshape(-1, 3)
    n, bucket = np.array(list(seen.values()), float), np.array([k[0] for k in seen])

    def climb(ratio, n, prior):
        weight = prior
        for _ in range(60):
            share = ratio * weight
            share = share / share.sum(1, keepdims=True)
            weight = (n[:, None] * share).sum(0) + prior
            weight = weight / weight.sum()
        return weight

    overall = climb(ratio, n, np.array([0.6, 0.3, 0.1]))
    weights = {}
    for k in range(lm.BUCKETS):
        prior = overall if k else np.array([0, overall[1], overall[2]]) / overall[1:].sum()
        weights[k] = climb(ratio[bucket == k], n[bucket == k], prior)
    found = []
    for i, t, _, _ in own:
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in t)
        score = 0.0
        for before, token in zip(["start", *t[:-1]], t, strict=True):
            c = contexts[before]
            a, b, u = weights[level(c)]
            p = a * (pairs[before, token] / c if c else 0) + b * words[token] / max(total, 1) + u / (distinct + 1)
            score += math.log10(p if total else 1 / (distinct + 1))
        found.append((i is None, i or 0, len(t), sum(words[w] > 0 for w in t), total, base, score))
    return sorted(found)


def check(frame, rows, trained, learned, **more):
    own = frame.withColumn("crc", id_crc())
    found = lm.scores(own, trained(F.col("crc")), learned(F.col("crc")), **more).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    want = brute(rows, lambda i: trained(crc(i)), lambda i: learned(crc(i)))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    # EM sees ratios in steps of half a power of two, so the weights differ a little.
    assert [g[6] for g in got] == pytest.approx([w[6] for w in want], rel=0.02, abs=0.05)


ROWS = [(i, prose(i, 30 + i % 50, 400)) for i in range(80)] + [(900 + i, t) for i, t in enumerate([None, *HARD, *mixed(17, 20)])] + [(None, "w1 W2 w3"), (5, prose(5, 35, 400))]


@pytest.mark.parametrize("block", [12 << 20, 500])
def test_scores_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    docs = documents([(i, t, 1.5) for i, t in ROWS], "doc_id bigint, text string, score double").select("doc_id", "text")
    check(docs, ROWS, lambda c: c % 7 != 2, lambda c: c % 7 == 6, parts=5)


def test_no_training_texts_none_to_learn_on_and_no_rows(documents):
    docs = documents(ROWS[:10])
    check(docs, ROWS[:10], lambda c: c < 0, lambda c: c < 0)
    check(docs, ROWS[:10], lambda c: c >= 0, lambda c: c < 0)
    assert lm.scores(documents([], name="none"), F.lit(True), F.lit(False)).count() == 0


def test_the_model_beats_the_base_on_held_out_documents(spark, sf_dir):
    found = op3_lm_scoring(spark, sf_dir).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_probabilities_sum_to_one(documents):
    """Over all words ever seen, the end and one unknown word, in a context that was seen."""
    rng = np.random.default_rng(1)
    weights = rng.dirichlet([1, 1, 1], lm.BUCKETS)
    words, pairs = np.array([5, 3, 2, 0]), np.array([2, 1, 1, 0])
    found = lm.Counted([], None, words, np.full(4, 4), pairs)
    assert lm.estimates(found, lm.Model(10, 3, weights)).sum() == pytest.approx(1)


def test_a_table_that_changes_between_reads_fails():
    import pyarrow as pa

    block = lm.block_of(pa.array(["a b c"]))
    keys = lm.keys_of(block, 1)
    packed = lm.planes(np.diff(keys.pairs, prepend=np.uint64(0)))
    payload = pa.table({"ids": [[1]], "lengths": [lm.small(block.lengths)], "tokens": [np.ascontiguousarray(block.tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()], "high": [block.high.tobytes()], "low": [block.low.tobytes()]})
    reply = {"part": [0], "crc": [zlib.crc32(packed)], "words": [lm.small(keys.word_counts)], "pairs": [lm.small(keys.pair_counts)], "words_kept": [None], "pairs_kept": [None]}
    assert lm.counted(payload, pa.table(reply), 1, kept=False).word.tolist() == [1, 1, 1, 1]
    with pytest.raises(ValueError):
        lm.counted(payload, pa.table({**reply, "crc": [1]}), 1, kept=False)
    with pytest.raises(ValueError):
        lm.counted(payload, pa.table(reply).slice(0, 0), 1, kept=False)
