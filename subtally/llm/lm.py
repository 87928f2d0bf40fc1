"""Language-model scoring by deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood estimates of its bigram, its unigram and a uniform
floor. The weights depend on how often the context was seen (in powers of two); expectation-maximisation learns them
from a part of the training texts on counts of the other part.

Counting and looking up are one exchange. Each task packs its texts into blocks and sends the distinct keys of a block
with their counts to the keys' partitions; there they are summed over all blocks, and each block gets the totals of its
own keys back. So a word that is everywhere costs one row per block, and no task or driver holds the vocabulary. A block
is made again from the same rows when totals come back; both sides carry a checksum, so a table that reads differently
the second time fails rather than giving wrong scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import split_words, stored, texts, word_ids

BLOCK_BYTES = 8 << 20
# Kinds of documents: counted; counted, and the weights are learned on it; scored only.
COUNTED, LEARNED_ON, SCORED = 0, 1, 2
END, START = b" end", b" start"  # no word has a blank
BUCKETS = 40
NONE = -10_000  # stands for the logarithm of an estimate of zero
STEPS = 2  # levels per power of two at which EM tells ratios of probabilities apart


# --- blocks -------------------------------------------------------------------------------------


@dataclass
class Block:
    lengths: np.ndarray  # tokens of each document, its end included
    tokens: np.ndarray  # local numbers of all tokens
    high: np.ndarray  # 128-bit digests of the local words, then of END and START
    low: np.ndarray

    def contexts(self) -> np.ndarray:
        """Of each token the one before it; START before the first of a document."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = len(self.high) - 1
        return before


def block_of(text: pa.Array) -> Block:
    bounds, words = split_words(text)
    ids, distinct = word_ids(words)
    names = [*distinct.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), END, START]
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, names)), np.uint64).reshape(-1, 2)
    lengths = np.diff(bounds) + 1
    tokens = np.full(len(ids) + len(lengths), len(names) - 2, np.int64)
    word = np.ones(len(tokens), bool)
    word[np.cumsum(lengths) - 1] = False
    tokens[word] = ids
    return Block(lengths, tokens, digests[:, 0].copy(), digests[:, 1].copy())


def pair_keys(block: Block) -> np.ndarray:
    """A 64-bit key for each token with its context; equal pairs have equal keys in every block."""
    key = block.high[block.contexts()] * np.uint64(0x9E3779B97F4A7C15) + (block.high[block.tokens] ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xD6E8FEB86659FD93)
    return key ^ (key >> np.uint64(32))


@dataclass
class Keys:
    """A block's distinct keys ordered by partition, and in it by key; bounds are those of the partitions."""

    words: np.ndarray  # local numbers in that order
    word_bounds: np.ndarray
    pairs: np.ndarray  # distinct keys in that order
    pair_bounds: np.ndarray
    place: np.ndarray  # of each token's pair among the distinct ones
    word_counts: np.ndarray
    pair_counts: np.ndarray


def keys_of(block: Block, parts: int) -> Keys:
    part = block.high % np.uint64(parts)
    words = np.lexsort((block.low, block.high, part))
    counts = np.bincount(block.tokens, minlength=len(block.high))
    counts[-1] = len(block.lengths)
    found, inverse, repeats = np.unique(pair_keys(block), return_inverse=True, return_counts=True)
    pair_part = (found % np.uint64(parts)).astype(np.int64)
    order = np.argsort(pair_part, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    edges = np.arange(parts + 1)
    return Keys(
        words, np.searchsorted(part[words].astype(np.int64), edges), found[order], np.searchsorted(pair_part[order], edges), rank[inverse], counts[words], repeats[order]
    )


def small(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs, that number of bytes first."""
    size = next(s for s in (1, 2, 4, 8) if s == 8 or values.max(initial=0) < 1 << 8 * s)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte: all lowest bytes first, so that equal high bytes compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def blocks_of(batches: Iterator[pa.RecordBatch], only: int | None = None) -> Iterator[tuple[int, int, pa.Array, Block]]:
    """(name, kind, ids, block): documents of one kind each; a block is full at BLOCK_BYTES, a text is never cut.

    With ``only`` the blocks of that kind are made, the same as without.
    """
    part = TaskContext.get().partitionId()
    made = [0, 0, 0]
    waiting: dict[int, list[pa.RecordBatch]] = {kind: [] for kind in ((COUNTED, LEARNED_ON, SCORED) if only is None else (only,))}

    def build(kind: int) -> tuple[int, int, pa.Array, Block]:
        made[kind] += 1
        rows = pa.Table.from_batches(waiting[kind]).combine_chunks()
        waiting[kind] = []
        text = pc.ascii_lower(texts(rows.column("text").chunk(0) if rows.column("text").num_chunks else pa.array([], pa.string())))
        return part << 24 | kind << 22 | made[kind], kind, rows.column("doc_id").combine_chunks(), block_of(text)

    for batch in batches:
        for kind, own in waiting.items():
            rows = batch.filter(pc.equal(batch.column("kind"), kind))
            if rows.num_rows:
                own.append(rows)
            if sum(x.nbytes for x in own) >= BLOCK_BYTES:
                yield build(kind)
    for kind, own in waiting.items():
        if own:
            yield build(kind)


# --- the exchange -------------------------------------------------------------------------------


def key_rows(docs: DataFrame, parts: int) -> DataFrame:
    names = ["block", "kind", "part", "high", "low", "words", "pairs", "pair_counts", "crc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, kind, _, block in blocks_of(batches):
            keys = keys_of(block, parts)
            rows = []
            for p in range(parts):
                w, q = keys.words[keys.word_bounds[p] : keys.word_bounds[p + 1]], keys.pairs[keys.pair_bounds[p] : keys.pair_bounds[p + 1]]
                if len(w) or len(q):
                    packed = planes(np.diff(q, prepend=np.uint64(0)))
                    counts = small(keys.word_counts[keys.word_bounds[p] : keys.word_bounds[p + 1]]), small(keys.pair_counts[keys.pair_bounds[p] : keys.pair_bounds[p + 1]])
                    rows.append((name, kind, p, planes(block.high[w]), planes(block.low[w]), counts[0], packed, counts[1], zlib.crc32(packed)))
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "block bigint, kind int, part int, high binary, low binary, words binary, pairs binary, pair_counts binary, crc bigint"
    return docs.mapInArrow(run, schema)


TOTALS = "block bigint, kind int, part int, crc bigint, words binary, words_kept binary, pairs binary, pairs_kept binary"


def totals_of(table: pa.Table) -> pa.Table:
    """For each block the totals of its keys in this partition; a row without a block has tokens and distinct words.

    ``kept`` totals leave out the documents that the weights are learned on.
    """
    rows = table.to_pylist()
    kinds = np.array([r["kind"] for r in rows])

    def summed(identity: np.ndarray, counts: list[np.ndarray], kinds: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
        """``identity``: a number for each key of all rows; returns totals and kept totals by row, and by key."""
        sizes = np.array([len(c) for c in counts])
        of_row, flat = np.repeat(kinds, sizes), np.concatenate(counts) if counts else np.zeros(0, np.int64)
        distinct = int(identity.max(initial=-1)) + 1
        total, kept = np.zeros(distinct, np.int64), np.zeros(distinct, np.int64)
        np.add.at(total, identity[of_row != SCORED], flat[of_row != SCORED])
        np.add.at(kept, identity[of_row == COUNTED], flat[of_row == COUNTED])
        cuts = np.cumsum(sizes)[:-1]
        return np.split(total[identity], cuts), np.split(kept[identity], cuts), total, kept

    high = np.concatenate([from_planes(r["high"]) for r in rows])
    low = np.concatenate([from_planes(r["low"]) for r in rows])
    order = np.lexsort((low, high))
    new = np.concatenate([[False], (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])])[: len(order)]
    identity = np.empty(len(order), np.int64)
    identity[order] = np.cumsum(new)
    words, words_kept, by_word, by_word_kept = summed(identity, [numbers(r["words"]) for r in rows], kinds)
    start = np.frombuffer(xxhash.xxh3_128_digest(START), np.uint64)
    is_start = np.zeros(len(by_word), bool)
    is_start[identity[(high == start[0]) & (low == start[1])]] = True
    seen = ~is_start & (by_word > 0)
    state = np.array([by_word[~is_start].sum(), seen.sum(), by_word_kept[~is_start].sum(), 0], np.int64)
    pairs = np.concatenate([np.cumsum(from_planes(r["pairs"]), dtype=np.uint64) for r in rows])
    _, identity = np.unique(pairs, return_inverse=True)
    del pairs
    pairs, pairs_kept, _, _ = summed(identity, [numbers(r["pair_counts"]) for r in rows], kinds)
    out = [(None, None, rows[0]["part"], None, state.tobytes(), None, None, None)]
    for i, r in enumerate(rows):
        learned = r["kind"] == LEARNED_ON
        out.append((r["block"], r["kind"], r["part"], r["crc"], small(words[i]), small(words_kept[i]) if learned else None, small(pairs[i]), small(pairs_kept[i]) if learned else None))
    kinds_of = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(TOTALS.split(", "), zip(*out, strict=True), kinds_of, strict=True)})


def payloads(docs: DataFrame, only: int | None = None) -> DataFrame:
    """The blocks again, as rows: tokens by local number (frequent words tend to have small ones) and words by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, kind, ids, block in blocks_of(batches, only):
            row = {
                "block": pa.array([name], pa.int64()),
                "kind": pa.array([kind], pa.int32()),
                "ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                "lengths": pa.array([small(block.lengths)], pa.binary()),
                "tokens": pa.array([np.ascontiguousarray(block.tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()], pa.binary()),
                "high": pa.array([block.high.tobytes()], pa.binary()),
                "low": pa.array([block.low.tobytes()], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(row)

    return docs.mapInArrow(run, "block bigint, kind int, ids array<bigint>, lengths binary, tokens binary, high binary, low binary")


@dataclass
class Counted:
    """A block with the totals of its keys, token by token."""

    ids: list
    block: Block
    word: np.ndarray
    context: np.ndarray
    pair: np.ndarray


def counted(payload: pa.Table, totals: pa.Table, parts: int, kept: bool) -> Counted:
    row = payload.to_pylist()[0]
    tokens = np.ascontiguousarray(np.frombuffer(row["tokens"], np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)
    block = Block(numbers(row["lengths"]), tokens, np.frombuffer(row["high"], np.uint64), np.frombuffer(row["low"], np.uint64))
    keys = keys_of(block, parts)
    word, pair = np.zeros(len(block.high), np.int64), np.zeros(len(keys.pairs), np.int64)
    names = ("words_kept", "pairs_kept") if kept else ("words", "pairs")
    seen = 0
    for reply in totals.to_pylist():
        p = reply["part"]
        a, b = keys.pair_bounds[p], keys.pair_bounds[p + 1]
        if reply["crc"] != zlib.crc32(planes(np.diff(keys.pairs[a:b], prepend=np.uint64(0)))):
            raise ValueError("the documents changed between two reads: store the table first")
        word[keys.words[keys.word_bounds[p] : keys.word_bounds[p + 1]]] = numbers(reply[names[0]])
        pair[a:b] = numbers(reply[names[1]])
        seen += b - a
    if seen != len(pair):
        raise ValueError("the documents changed between two reads: store the table first")
    return Counted(row["ids"], block, word[block.tokens], word[block.contexts()], pair[keys.place])


# --- the model ----------------------------------------------------------------------------------


@dataclass
class Model:
    tokens: int  # of the training texts, ends included
    distinct: int
    weights: np.ndarray  # by bucket of the context's count: bigram, unigram, uniform


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket for each power of two."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def evidence(totals: DataFrame, blocks: DataFrame, parts: int, tokens: int, distinct: int) -> DataFrame:
    """(bucket, pair, word, n) over all tokens that the weights are learned on: by how much the bigram's and the
    unigram's estimate exceed the uniform one, in steps of a power of two, NONE for an estimate of zero.

    That is all EM needs of a token. The number of rows is bounded by the steps, not by the texts.
    """

    def run(payload: pa.Table, totals: pa.Table) -> pa.Table:
        found = counted(payload, totals, parts, kept=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            pair = np.where(found.pair > 0, np.rint(STEPS * np.log2(found.pair / found.context * (distinct + 1))), NONE)
            word = np.where(found.word > 0, np.rint(STEPS * np.log2(found.word / max(tokens, 1) * (distinct + 1))), NONE)
        rows, n = np.unique(np.stack([bucket_of(found.context), pair.astype(np.int64), word.astype(np.int64)]), axis=1, return_counts=True)
        return pa.table({"bucket": rows[0], "pair": rows[1], "word": rows[2], "n": n})

    own = totals.filter(F.col("kind") == LEARNED_ON).groupBy("block")
    found = blocks.groupBy("block").cogroup(own)
    return found.applyInArrow(run, "bucket bigint, pair bigint, word bigint, n bigint").groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))


def learned(rows: list, rounds: int = 60) -> np.ndarray:
    """EM by bucket. Each bucket starts from and is drawn by as much as one token to the weights over all buckets."""
    table = np.array([(r["bucket"], r["pair"], r["word"], r["n"]) for r in rows], float).reshape(-1, 4)
    levels = table[:, 1:3]
    ratio = np.column_stack([np.where(levels == NONE, 0, 2 ** (levels / STEPS)), np.ones(len(table))])

    def climb(own: np.ndarray, n: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
        weight = prior
        for _ in range(rounds):
            share = own * weight
            share = share / share.sum(1, keepdims=True)
            weight = (n[:, None] * share).sum(0) + strength * prior
            weight = weight / weight.sum()
        return weight

    start = np.array([0.6, 0.3, 0.1])
    overall = climb(ratio, table[:, 3], start, 1.0)
    weights = np.tile(overall, (BUCKETS, 1))
    for bucket in range(BUCKETS):
        here = table[:, 0] == bucket
        prior = np.array([0.0, overall[1], overall[2]]) / (overall[1] + overall[2]) if bucket == 0 else overall
        weights[bucket] = climb(ratio[here], table[here, 3], prior, 1.0)
    return weights


def estimates(found: Counted, model: Model) -> np.ndarray:
    """The model's probability of every token."""
    weight = model.weights[bucket_of(found.context)]
    pair = found.pair / np.maximum(found.context, 1)
    word = found.word / max(model.tokens, 1)
    uniform = 1 / (model.distinct + 1)
    if not model.tokens:
        return np.full(len(pair), uniform)
    return weight[:, 0] * pair + weight[:, 1] * word + weight[:, 2] * uniform


def scores(docs: DataFrame, trained_on: Column, learned_on: Column, parts: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every whole text of ``docs`` (doc_id, text).

    ``trained_on`` says which rows are counted, ``learned_on`` which of those the weights are learned on; nulls count
    as no. Tokens are the words, A-Z lower-cased, and one end per text; ``base_score`` is the add-one unigram score,
    ``score`` the model's log10 probability. A null text is empty, a null doc_id stays null, repeated rows are counted
    and scored each. A text is never cut: a very long one is a block of its own. Without training texts every probability is the uniform one. ``parts`` is the number of
    partitions that the keys are dealt to, by default spark.sql.shuffle.partitions; ``docs`` must be a stored table.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = F.when(F.coalesce(trained_on, F.lit(False)), F.when(F.coalesce(learned_on, F.lit(False)), LEARNED_ON).otherwise(COUNTED)).otherwise(SCORED)
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", kind.alias("kind"))
    totals = stored(key_rows(own, parts).groupBy("part").applyInArrow(totals_of, TOTALS), "lm-totals")
    states = totals.filter("block IS NULL").select("words").toArrow().column(0).to_pylist()  # one row a partition
    tokens, distinct, kept, _ = (int(x) for x in np.sum([np.frombuffer(s, np.int64) for s in states], axis=0)) if states else (0, 0, 0, 0)
    totals = totals.filter("block IS NOT NULL")
    weights = learned(evidence(totals, payloads(own, LEARNED_ON), parts, kept, distinct).collect())
    model = Model(tokens, distinct, weights)

    def run(payload: pa.Table, totals: pa.Table) -> pa.Table:
        found = counted(payload, totals, parts, kept=False)
        starts = np.cumsum(found.block.lengths) - found.block.lengths
        base = np.log10((found.word + 1) / (model.tokens + model.distinct + 1))
        n = len(found.ids)
        return pa.table(
            {
                "doc_id": pa.array(found.ids, pa.int64()),
                "n_tokens": found.block.lengths,
                "n_known": np.add.reduceat((found.word > 0).astype(np.int64), starts),
                "train_tokens": np.full(n, model.tokens, np.int64),
                "base_score": np.add.reduceat(base, starts),
                "score": np.add.reduceat(np.log10(estimates(found, model)), starts),
            }
        )

    schema = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return payloads(own).groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, schema)
