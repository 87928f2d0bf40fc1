"""Quality rules: statistics of every text, a rule on two of them, and an isolation forest on the rest.

Random splits isolate documents with unusual statistics early, so short path lengths mark them. The forest is grown on
small random samples, as the method has it; the threshold on its score comes from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtally.llm.common import first_by_hash, lean, split_words, text_bytes, texts, word_ids

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_letters")
# The characters that count as symbols, and the white space between words.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
MARKS = b"!\"'()+,-./:;=?@[\\]^_`{}~"


def kinds_of_bytes() -> dict[str, np.ndarray]:
    """For each count over bytes, 1 for the bytes that it counts."""
    byte = np.arange(256)

    def among(members) -> np.ndarray:
        return np.isin(byte, list(members)).astype(np.int64)

    first_of_character = (byte & 0xC0) != 0x80
    capital, small = among(range(65, 91)), among(range(97, 123))
    return {
        "word_chars": first_of_character & (among(BLANKS) == 0),
        "n_symbols": among(SYMBOLS),
        "n_capitals": capital,
        "n_marks": among(MARKS),
        "n_letters": capital + small + (first_of_character & (byte >= 0x80)),
    }


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each stretch of values; ``starts`` has one entry more than there are stretches."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def repeated_words(ids: np.ndarray, document: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of five words found twice or more in that text."""
    covered = np.zeros(len(ids) + WINDOW, bool)
    n = len(ids) - WINDOW + 1
    if n > 0:
        inside = np.flatnonzero(document[:n] == document[WINDOW - 1 :])
        mixed = document.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        key = mixed[inside]
        for k in range(WINDOW):
            key = (key ^ (ids[inside + k].astype(np.uint64) + np.uint64(1))) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
        order = np.argsort(key)
        ranked, at = key[order], inside[order]
        same = ranked[1:] == ranked[:-1]
        left, right = at[:-1][same], at[1:][same]
        equal = document[left] == document[right]
        for k in range(WINDOW):
            equal &= ids[left + k] == ids[right + k]
        found = np.concatenate([left[equal], right[equal]])
        for i in np.unique(document[np.concatenate([left[~equal], right[~equal]])]):  # different windows, one key
            lo, hi = bounds[i], bounds[i + 1] - WINDOW + 1
            windows = [tuple(ids[p : p + WINDOW]) for p in range(lo, hi)]
            again = {w for w in windows if windows.count(w) > 1}
            found = np.concatenate([found, [p for p, w in zip(range(lo, hi), windows, strict=True) if w in again]]).astype(np.int64)
        for k in range(WINDOW):
            covered[found + k] = True
    return sums(covered[: len(ids)], bounds)


def duplicate_lines(lines: list[bytes]) -> int:
    full = [x for x in lines if x.strip(BLANKS)]
    return len(full) - len(set(full))


def statistics_of(text: pa.Array) -> dict[str, np.ndarray]:
    """The counts of a batch of texts without nulls."""
    starts, raw = text_bytes(text)
    found = {name: sums(kind[raw], starts) for name, kind in kinds_of_bytes().items()}
    bounds, words = split_words(text)
    ids, _ = word_ids(words)
    lengths = np.diff(bounds)
    document = np.repeat(np.arange(len(text)), lengths)
    found["n_words"] = lengths
    found["n_repeat_words"] = repeated_words(ids, document, bounds)
    whole = raw.tobytes()
    edges = starts.tolist()
    found["n_dup_lines"] = np.array([duplicate_lines(whole[a:b].split(b"\n")) for a, b in zip(edges[:-1], edges[1:], strict=True)], np.int64)
    return found


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, the counts of COUNTS and base_failed, for every row.

    A null or empty text has no word and fails the base rule; repeated rows are counted each; columns that aren't kept are
    left out. A text of any length is counted whole, in a batch of its own where it fills one.
    """
    schema = T.StructType([*docs.select(*keep).schema, *(T.StructField(name, T.LongType()) for name in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics_of(texts(batch.column("_text")))
            columns = [batch.column(c) for c in keep] + [pa.array(found[c], pa.int64()) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *COUNTS])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(lean(run), schema).withColumn("base_failed", base_failed())


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Shares and a mean, so that a statistic doesn't grow with the text's length; cut off where more says no more."""
    words = np.maximum(counts["n_words"], 1)
    return np.column_stack(
        [
            np.minimum(counts["n_symbols"] / words, 0.5),
            counts["n_capitals"] / np.maximum(counts["n_letters"], 1),
            np.minimum(counts["n_marks"] / words, 0.5),
            counts["n_repeat_words"] / words,
            counts["n_dup_lines"] / words,
            np.minimum(counts["word_chars"] / words / 10, 3),
        ]
    )


N_FEATURES = 6


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n, the unit of path lengths."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays over nodes: feature (-1 at a leaf), threshold, left child (right is next), path length at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    path: np.ndarray
    depth: int
    unit: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the minus mean path over the unit: near 1 for what is isolated early, 0.5 and less for the rest."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for tree in range(len(self.feature)):
            feature, threshold, left = self.feature[tree], self.threshold[tree], self.left[tree]
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f < 0, node, left[node] + (x[rows, f] >= threshold[node]))
            total += self.path[tree][node]
        return np.exp2(-total / len(self.feature) / self.unit)


def grow(sample: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = 100, size: int = 256, seed: int = 7) -> Forest | None:
    """Each tree on ``size`` random rows of the sample.

    A split takes a random feature at a random value of the box that the splits above leave of ``low`` to ``high``, so
    regions where the sample has no rows are cut off early as well.
    """
    if not len(sample):
        return None
    rng = np.random.default_rng(seed)
    size = min(size, len(sample))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    grown = []
    for _ in range(trees):
        feature, threshold, left, path = [], [], [], []
        waiting = [(sample[rng.choice(len(sample), size, replace=False)], low, high, 0)]
        made = 1
        while waiting:
            rows, lo, hi, level = waiting.pop(0)
            varying = np.flatnonzero(hi > lo)
            if level == depth or len(rows) < 2 or not len(varying):
                feature.append(-1), threshold.append(0.0), left.append(0), path.append(level + float(average_path(len(rows))))
                continue
            f = rng.choice(varying)
            cut = rng.uniform(lo[f], hi[f])
            above = rows[:, f] >= cut
            feature.append(int(f)), threshold.append(float(cut)), left.append(made), path.append(0.0)
            below_hi, above_lo = hi.copy(), lo.copy()
            below_hi[f] = above_lo[f] = cut
            waiting += [(rows[~above], lo, below_hi, level + 1), (rows[above], above_lo, hi, level + 1)]
            made += 2
        grown.append((feature, threshold, left, path))
    width = max(len(t[0]) for t in grown)

    def padded(k: int, kind: type) -> np.ndarray:
        return np.array([list(t[k]) + [0] * (width - len(t[k])) for t in grown], kind)

    return Forest(padded(0, np.int64), padded(1, float), padded(2, np.int64), padded(3, float), depth, max(float(average_path(size)), 1e-9))


BINS = 1000


def scored(statistics: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows with the forest's score; without a forest it is 0."""
    schema = T.StructType([*statistics.schema, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features({c: batch.column(c).to_numpy() for c in COUNTS})
            score = forest.score(x) if forest else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "score"])

    return statistics.mapInArrow(lean(run), schema)


@dataclass
class Verdict:
    """What decides on a document that the base rule lets pass."""

    forest: Forest | None
    threshold: float


def box_of(statistics: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The least and the greatest of each feature over all rows; None if there are none. Six pairs reach the driver."""
    names = [f"f{k}" for k in range(N_FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(N_FEATURES, np.inf), np.full(N_FEATURES, -np.inf)
        for batch in batches:
            if batch.num_rows:
                x = features({c: batch.column(c).to_numpy() for c in COUNTS})
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if (low <= high).all():
            yield pa.RecordBatch.from_arrays([pa.array([a, b]) for a, b in zip(low, high, strict=True)], names)

    found = statistics.select(*COUNTS).mapInArrow(lean(run), ", ".join(f"{c} double" for c in names))
    [row] = found.agg(*(F.min(c) for c in names), *(F.max(c) for c in names)).collect()
    return None if row[0] is None else (np.array(row[:N_FEATURES]), np.array(row[N_FEATURES:]))


def sample_rows(statistics: DataFrame, rows: int) -> np.ndarray:
    """Features of at most ``rows`` rows, those that come first by a hash of id and counts."""
    kept = first_by_hash(statistics.select("doc_id", *COUNTS), rows, "doc_id", *COUNTS).toPandas()
    return features({c: kept[c].to_numpy() for c in COUNTS})


def threshold_of(histogram: np.ndarray, good_lost: float) -> float:
    """The score from which rows are rejected; ``histogram`` has the good and the bad rows by score bin.

    Of the thresholds that reject at most the share ``good_lost`` of the good rows, the one with the most bad rows
    caught, a good row's share counting ten times. With no bad rows nothing is rejected.
    """
    good, bad = (h[::-1].cumsum() / max(h.sum(), 1) for h in histogram)
    gain = np.where(good <= good_lost, bad - 10 * good, -1.0)
    best = int(gain.argmax())
    return (BINS - 1 - best) / BINS if gain[best] > 0 else 2.0


def fit(statistics: DataFrame, labels: DataFrame, sample: int = 8192, good_lost: float = 0.002) -> Verdict:
    """A forest on a bounded sample of the rows that pass the base rule, and its threshold from all labelled rows.

    ``statistics`` has doc_id and the counts; ``labels`` doc_id and quality (1 good, 0 bad; others and nulls are left
    out). Trees see rows labelled good, or any where there are none; their box is that of all rows that pass. Among equal
    or repeated ids every pair counts. Without labels nothing is rejected.
    """
    passing = statistics.filter(~F.col("base_failed"))
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    labelled = passing.join(known, "doc_id")
    box, good = box_of(passing), sample_rows(labelled.filter("quality = 1"), sample)
    forest = grow(good if len(good) else sample_rows(passing, sample), *box) if box else None
    rows = scored(labelled.select("quality", *COUNTS), forest)
    bins = rows.groupBy("quality", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count()
    histogram = np.zeros((2, BINS))
    for row in bins.collect():  # two rows a bin at most
        histogram[1 - row["quality"], row["bin"]] = row["count"]
    return Verdict(forest, threshold_of(histogram, good_lost))


def passing_rows(docs: DataFrame, verdict: Verdict) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics_of(texts(batch.column("text")))
            failed = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
            score = verdict.forest.score(features(found)) if verdict.forest else np.zeros(len(failed))
            yield batch.filter(pa.array(~failed & (score < verdict.threshold)))

    return docs.mapInArrow(lean(run), docs.schema)


def judge(statistics: DataFrame, verdict: Verdict) -> DataFrame:
    """Adds ``score`` and ``kept``: false if the base rule failed or the score reaches the threshold.

    Rows with equal statistics have equal scores, so ties and repeated rows share a verdict; without a forest the score is 0.
    """
    return scored(statistics, verdict.forest).withColumn("kept", ~F.col("base_failed") & (F.col("score") < verdict.threshold))
