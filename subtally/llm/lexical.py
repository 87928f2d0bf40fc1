"""Ranked lexical search: a trie of documents' term vectors, searched for each item by branch and bound.

Items come in blocks. For a block, every document is reduced to the terms that the block's items hold; the vectors of
some thousand documents at a time, terms in order of corpus frequency, share the paths of a trie. A node knows for each
term the largest count in any document below it, and the smallest length measure m: together they bound every score
below, so a search that goes depth first leaves out what cannot reach the ten best.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtally.llm.common import stored, texts

# What separates terms (ASCII but letters and digits), and the weights of the score.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, LENGTH_SHARE = 1_000_000_000, 90
# Terms of all items of a block, about; a longer item is a block of its own.
BLOCK_TERMS = 50_000
# Cells (documents x terms of the block) of one trie's table of counts, and its documents at most.
CELLS, DOCUMENTS = 1 << 24, 4096
LEAF = 24  # documents below which a node isn't split further


def term_lists(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's terms start (one entry more), and all terms, A-Z lower-cased."""
    parts = pc.split_pattern_regex(pc.ascii_lower(text), SEPARATORS)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))])
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return before[bounds], flat.filter(full)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): a number for each row, and its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, terms = term_lists(texts(batch.column("text")))
            lists = [sorted(set(terms.slice(a, b - a).to_pylist())) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            columns = [batch.column("item"), batch.column("item_id"), pa.array(lists, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "terms"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "text")
    return numbered.mapInArrow(run, "item bigint, item_id bigint, terms array<string>")


def term_vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: n counts all of them, the arrays only those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            starts, terms = term_lists(texts(batch.column("text")))
            coded = terms.dictionary_encode()
            number = pc.fill_null(pc.index_in(coded.dictionary, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            code = number[coded.indices.to_numpy(zero_copy_only=False)]
            n = np.diff(starts)
            owner = np.repeat(np.arange(len(n)), n)[code >= 0]
            cells, counts = np.unique(owner * max(len(vocabulary), 1) + code[code >= 0], return_counts=True)
            stops = np.searchsorted(cells, np.arange(len(n) + 1) * max(len(vocabulary), 1)).astype(np.int32)
            vectors = [cells % max(len(vocabulary), 1), counts]
            columns = [batch.column("doc_id"), pa.array(n, pa.int64())]
            columns += [pa.ListArray.from_arrays(pa.array(stops), pa.array(x.astype(np.int64))) for x in vectors]
            found = pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])
            yield found.filter(pa.array(n > 0))

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id bigint, n bigint, terms array<bigint>, counts array<bigint>")


class Best:
    """The ``keep`` best (score, doc_id) so far; equal scores by the smaller id."""

    def __init__(self, keep: int):
        self.keep, self.heap, self.least = keep, [], 0

    def admits(self, score: int, doc_id: int) -> bool:
        return score > 0 and (len(self.heap) < self.keep or (score, -doc_id) > self.heap[0])

    def offer(self, score: int, doc_id: int) -> None:
        if self.admits(score, doc_id):
            (heapq.heappush if len(self.heap) < self.keep else heapq.heapreplace)(self.heap, (score, -doc_id))
            if len(self.heap) == self.keep:
                self.least = self.heap[0][0]


class Trie:
    """Documents in the order of their term vectors, terms by descending frequency; nodes are ranges of them.

    A node's children divide its range by the next term of the path. Chains without a fork are one node, and a node with
    few documents or none that go on is a leaf.
    """

    def __init__(self, counts: np.ndarray, m: np.ndarray, ids: np.ndarray):
        """``counts`` is documents x terms, columns by descending frequency of the term; null ids are the largest number."""
        paths = [tuple(np.flatnonzero(row).tolist()) for row in counts]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        paths = [paths[i] for i in order]
        self.counts, self.m, self.ids = counts[order], m[order], ids[order]
        self.children: list[list[int]] = []
        self.range: list[tuple[int, int]] = []
        waiting = [(0, len(paths), 0, -1)]
        while waiting:
            low, high, depth, parent = waiting.pop()
            # Paths are sorted, so what the first and the last share all share.
            first, last = paths[low], paths[high - 1]
            while depth < len(first) and depth < len(last) and first[depth] == last[depth]:
                depth += 1
            own = len(self.range)
            self.range.append((low, high))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(own)
            if high - low > LEAF and first != last:
                at = low
                while at < high:
                    stop = at + 1
                    term = paths[at][depth : depth + 1]
                    while stop < high and paths[stop][depth : depth + 1] == term:
                        stop += 1
                    waiting.append((at, stop, depth + 1, own))
                    at = stop
        # Parents come before children, so the other way round every child is ready first.
        n = len(self.range)
        self.most = np.zeros((n, counts.shape[1]), counts.dtype)
        self.least_m, self.least_id = np.zeros(n, np.int64), [0] * n
        for node in range(n - 1, -1, -1):
            below = self.children[node]
            if below:
                self.most[node] = self.most[below].max(axis=0)
                self.least_m[node], self.least_id[node] = self.least_m[below].min(), min(self.least_id[c] for c in below)
            else:
                low, high = self.range[node]
                self.most[node] = self.counts[low:high].max(axis=0)
                self.least_m[node], self.least_id[node] = self.m[low:high].min(), int(self.ids[low:high].min())

    def search(self, columns: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Offers every document that can be among the best; returns how many documents were scored."""
        scored, least_id = 0, self.least_id
        bounds = bounds_of(self.most[:, columns], self.least_m, weights).tolist()
        waiting = [0]
        while waiting:
            node = waiting.pop()
            if not best.admits(bounds[node], least_id[node]):
                continue
            if self.children[node]:
                # The most promising child is taken next, the others wait below it.
                waiting += sorted((c for c in self.children[node] if bounds[c] >= best.least), key=bounds.__getitem__)
                continue
            low, high = self.range[node]
            found = scores(self.counts[low:high, columns], self.m[low:high], weights)
            scored += high - low
            for i in np.flatnonzero(found >= max(best.least, 1)).tolist():
                best.offer(int(found[i]), int(self.ids[low + i]))
        return scored


def scores(counts: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over the terms of weight * ((SCALE * count) div (1000 * count + 8 * m)); it grows with counts and falls with m."""
    wide = counts.astype(np.int64)
    return ((SCALE * wide) // (1000 * wide + 8 * m[:, None])) @ weights


def bounds_of(counts: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Whole numbers that ``scores`` doesn't exceed: without rounding down, and with room for the error of doubles."""
    wide = counts.astype(np.float64)
    wide = wide / (1000 * wide + 8 * m[:, None])
    return np.floor((wide @ weights.astype(np.float64)) * (SCALE * (1 + 1e-12))).astype(np.int64) + 1


NO_ID = np.iinfo(np.int64).max


def best_of_block(vectors: DataFrame, items: list[tuple[int, list[str]]], vocabulary: list[str], keep: int) -> DataFrame:
    """(item, score, doc_id): for every item the best documents of each task, at most ``keep``; null ids come last.

    Only the best of every task leave it, and they are cut down in two steps, so no task sees those of all tasks.
    """
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not vocabulary:
        return vectors.sparkSession.createDataFrame([], "item bigint, score bigint, doc_id bigint")
    held = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # a row per term of the block
    # Columns by descending frequency; terms that no document has score nothing.
    ranked = sorted(held, key=lambda t: (-held[t], t))
    column = {vocabulary[t]: i for i, t in enumerate(ranked)}
    weight = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * held[t] + 1))) for t in ranked], np.int64)
    place = np.full(len(vocabulary), -1, np.int64)
    place[ranked] = np.arange(len(ranked))
    wanted = []
    for item, terms in items:
        own = np.array(sorted(column[t] for t in terms if t in column), np.int64)
        if len(own):
            wanted.append((item, own, weight[own]))

    # Only documents with a term of the block; m by exact division in decimals.
    share = f"cast(cast({LENGTH_SHARE * n_docs} AS decimal(19, 0)) * cast(n AS decimal(19, 0)) AS decimal(38, 0))"
    measured = vectors.filter("size(terms) > 0").selectExpr("doc_id", f"{100 - LENGTH_SHARE} + {share} DIV {n_terms}BD AS m", "terms", "counts")
    size = max(1, min(DOCUMENTS, CELLS // len(ranked)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(keep) for _ in wanted]
        for batch in sized(batches, size):
            starts = batch.column("terms").offsets.to_numpy()
            terms, counts = (batch.column(c).flatten().to_numpy() for c in ("terms", "counts"))
            starts = starts - starts[0]
            kind = np.uint16 if not len(counts) or counts.max() < 1 << 16 else np.int64
            table = np.zeros((batch.num_rows, len(ranked)), kind)
            table[np.repeat(np.arange(batch.num_rows), np.diff(starts)), place[terms]] = counts
            ids = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False)
            trie = Trie(table, batch.column("m").to_numpy(zero_copy_only=False), ids)
            for (_, columns, weights), own in zip(wanted, best, strict=True):
                trie.search(columns, weights, own)
        rows = [(item, score, -x) for (item, _, _), own in zip(wanted, best, strict=True) for score, x in own.heap]
        task = TaskContext.get().partitionId() % 256
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([None if r[2] == NO_ID else r[2] for r in rows], pa.int64()),
                pa.array([task] * len(rows), pa.int32()),
            ],
            ["item", "score", "doc_id", "task"],
        )

    found = measured.mapInArrow(run, "item bigint, score bigint, doc_id bigint, task int")
    return ranked_rows(ranked_rows(found, keep, "item", "task"), keep, "item").select("item", "score", "doc_id")


def ranked_rows(rows: DataFrame, keep: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def sized(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows``, but for the last."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - sum(b.num_rows for b in waiting))
            batch = batch.slice(part.num_rows)
            waiting.append(part)
            if sum(b.num_rows for b in waiting) == rows:
                yield pa.concat_batches(waiting)
                waiting = []
    if waiting:
        yield pa.concat_batches(waiting)


def blocks_of(items: DataFrame, block_terms: int) -> Iterator[list]:
    """The items in blocks of about ``block_terms`` terms; one block at a time reaches the driver."""
    total = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    count = max(1, -(-total // block_terms))
    for block in range(count):
        yield items.filter(F.pmod(F.xxhash64("item"), F.lit(count)) == block).select("item", "terms").collect()


def top_documents(docs: DataFrame, items: DataFrame, keep: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``keep`` best documents with a score above zero of every row of ``items``.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), a document's m 10 + (90 n N) div L. Equal scores rank by
    doc_id, null ids last; repeated documents rank each, repeated items are answered each, and an item without terms, or
    whose terms no document holds, has no row. Null texts have no terms; other columns are left out. A very long text
    is one row whose terms a worker counts at once.
    """
    own = stored(item_terms(items), "items")
    parts = []
    for block in blocks_of(own, block_terms):
        vocabulary = sorted({t for row in block for t in row["terms"]})
        vectors = stored(term_vectors(docs, vocabulary), "vectors")
        parts.append(stored(best_of_block(vectors, [(r["item"], r["terms"]) for r in block], vocabulary, keep), "best"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    ranked = ranked_rows(found, keep, "item")
    return ranked.join(own.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
