import re
from collections import Counter

import numpy as np
import pytest

from subtally.llm import quality
from subtally.llm.queries import op8_quality
from tests.llm.texts import HARD, mixed, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_statistics_are_exact(documents):
    repeated = ["a b c d e f " * 4, "same line here\n" * 3 + "x", "a a a a a a a", "p q r s t\n" + "p q r s t"]
    texts = [None, *HARD, *mixed(5, 150, 80), *repeated, prose(5, 3000, 20), "#$% | <b> & *"]
    docs = documents([(i, t, 7) for i, t in enumerate(texts)], "doc_id bigint, text string, n_words int")
    for row in quality.with_statistics(docs, "doc_id").collect():
        want = brute(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])




def test_held_out_verdicts(spark, sf_dir):
    found = op8_quality(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").select("quality", "kept", "base_failed").toPandas()
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert not rows[rows["base_failed"]]["kept"].any()
    good = rows[(rows["quality"] == 1) & ~rows["base_failed"]]
    assert good["kept"].mean() > 0.95
    assert rows[rows["quality"] == 0]["kept"].mean() < 0.1


@pytest.fixture
def corpus(documents):
    good = [(i, prose(i, 60 + i % 40), 1.0) for i in range(150)]
    bad = [(1000 + i, " | ".join(prose(i + 500, 60).split()), 2.0) for i in range(30)]
    return documents([*good, *bad, (None, prose(77, 50), 0.0), (2000, None, 0.0)], "doc_id bigint, text string, score double")


def test_the_forest_rejects_what_labels_call_bad(spark, corpus):
    labels = spark.createDataFrame([(i, int(i < 1000)) for i in [*range(0, 150, 2), *range(1000, 1030, 2)]] + [(3, None)], "doc_id bigint, quality int")
    statistics = quality.with_statistics(corpus, "doc_id")
    kept = {r.doc_id: r.kept for r in quality.judge(statistics, quality.fit(statistics, labels)).collect()}
    assert not any(kept[i] for i in range(1000, 1030)) and not kept[2000]
    assert sum(kept[i] for i in range(150)) >= 147


def test_a_bad_kind_outside_the_sample_spans_the_box(spark, documents):
    plain = [(i, prose(i, 60 + i % 40)) for i in range(300)]
    rare = [(1000 + i, " ".join(w[0] + "|" + w[2:] for w in prose(2000 + i, 70).split())) for i in range(2)]  # differ in symbols only
    statistics = quality.with_statistics(documents([*plain, *rare]), "doc_id").filter("NOT base_failed").localCheckpoint()
    labels = spark.createDataFrame([(i, 1) for i in range(300)] + [(1000, 0), (1001, 0)], "doc_id bigint, quality int")
    every = quality.features({c: np.array([r[c] for r in statistics.collect()]) for c in quality.COUNTS})
    low, high = quality.box_of(statistics)
    assert (low == every.min(0)).all() and (high == every.max(0)).all()
    kept = {r.doc_id: r.kept for r in quality.judge(statistics, quality.fit(statistics, labels, sample=20)).collect()}
    assert {1000, 1001} <= set(kept) and not kept[1000] and not kept[1001]
    assert sum(kept[i] for i in range(300)) >= 297


def test_without_labels_only_the_base_rule_rejects(spark, corpus):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    statistics = quality.with_statistics(corpus, "doc_id")
    verdict = quality.fit(statistics, labels)
    assert all(r.kept != r.base_failed for r in quality.judge(statistics, verdict).collect())
    empty = statistics.limit(0)
    assert quality.judge(empty, quality.fit(empty, labels)).count() == 0


def test_thresholds_keep_the_good():
    histogram = np.zeros((2, quality.BINS))
    histogram[0, 300:500] = 10
    histogram[1, 600:700] = 3
    assert quality.threshold_of(histogram, 0.002) == pytest.approx(0.6)
    histogram[0, 650] = 1  # one good row among the bad ones is worth losing
    assert 0.5 < quality.threshold_of(histogram, 0.002) <= 0.6
