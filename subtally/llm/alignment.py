"""Cross-tokenizer alignment: each distinct text is tokenised and aligned once, its pair counts weighted by its copies.

Texts are shuffled whole, so that copies meet before any tokenizer runs. What a text's tokens measure against the corpus
comes back to the documents by the text's digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import blank_parts, joined, stored, texts
from subtally.llm.packing import ChunkEncoder, byte_of_symbol
from subtally.llm.pieces import MARK, chunks_are_independent, read_model

# Pairs that are sent to every task at most; more of them are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
# A key with more than this share of all rows is joined by broadcast: there are at most so many such keys.
HOT_SHARE = 1000


class Aligned(NamedTuple):
    """Units (words or texts) one after another; unit i has n[i] = (tokens of A, of B, groups), and links, groups at [at[i], at[i + 1])."""

    spelled: np.ndarray
    n: np.ndarray
    links: np.ndarray
    links_at: np.ndarray
    groups: memoryview
    groups_at: np.ndarray


class Aligner:
    """Tokens of both vocabularies for texts, cut into groups where both end, and the links inside.

    Both tokenizers start anew at a blank before a word, so a word that stands often in a batch of texts is aligned once
    and texts are put together by position. A text in which that isn't sure for either goes through the libraries whole.
    """

    def __init__(self, byte_json: str, piece_model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.bytes = ChunkEncoder(byte_json)
        self.bytes.tokenizer.encode_special_tokens = True  # control strings inside texts are plain text
        self.pieces = SentencePieceProcessor(model_proto=piece_model)
        self.independent = chunks_are_independent(piece_model)
        symbols = byte_of_symbol()
        vocabulary = self.bytes.tokenizer.get_vocab()
        a_text = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_text[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        b_text = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            b_text.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(MARK, " ").encode())
        self.a_text, self.b_text = pa.array(a_text, pa.large_binary()), pa.array(b_text, pa.large_binary())
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (a_text, b_text))
        # Each id's decimal number as it stands inside and at the end of a group's side: a1,a2|b1,b2;
        marks = ((len(a_text), b","), (len(a_text), b"|"), (len(b_text), b","), (len(b_text), b";"))
        self.names = pa.array([b"%d%s" % (i, mark) for n, mark in marks for i in range(n)], pa.large_binary())

    def spells(self, ids: np.ndarray, side: pa.Array, text: bytes) -> bool:
        spelled, end = joined(side, pa.array(ids), np.array([len(ids)]))
        return bytes(spelled[: end[0]]) == text

    def align(self, units: list[str], whole: bool) -> Aligned:
        """Tokens, groups and links of each unit, a text without its leading blank. Where the tokens of either vocabulary
        don't spell blank and unit, it has none. Links are pairs a * vocabulary of b + b, one for each overlap.
        """
        led = [(" " + x).encode() for x in units]
        raw = (self.bytes.whole([x.decode() for x in led]) if whole else self.bytes.chunks(units)) if units else []
        listed = self.pieces.encode(units, out_type=int, num_threads=1) if units else []
        n_a = np.array([len(x) // 4 for x in raw], np.int64)
        n_b = np.array([len(x) for x in listed], np.int64)
        a = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
        b = np.fromiter(chain.from_iterable(listed), np.int64, n_b.sum())
        size = np.array([len(x) for x in led], np.int64)
        spelled = (sums_of(self.a_size[a], n_a) == size) & (sums_of(self.b_size[b], n_b) == size)
        if not (spelled.all() and self.spells(a, self.a_text, b"".join(led)) and self.spells(b, self.b_text, b"".join(led))):
            at_a, at_b = starts_of(n_a), starts_of(n_b)
            for i in np.flatnonzero(spelled).tolist():
                own = self.spells(a[at_a[i] : at_a[i + 1]], self.a_text, led[i])
                spelled[i] = own and self.spells(b[at_b[i] : at_b[i + 1]], self.b_text, led[i])
            a, b = a[np.repeat(spelled, n_a)], b[np.repeat(spelled, n_b)]
            n_a, n_b, size = n_a * spelled, n_b * spelled, size * spelled
        a_end, b_end, unit_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(size)
        # Between two neighbouring ends of either side lies exactly one overlap, and each overlap is such a stretch.
        ends = np.union1d(a_end, b_end)
        links = a[np.searchsorted(a_end, ends)] * len(self.b_text) + b[np.searchsorted(b_end, ends)]
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        links_at = np.concatenate([[0], np.searchsorted(ends, unit_end, side="right")])
        both_at = np.concatenate([[0], np.searchsorted(both, unit_end, side="right")])
        # In the listing a token comes after the other side's tokens of all groups before, those of B also after A's in their own.
        a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        a_count, b_count = (np.bincount(g, minlength=len(both)) for g in (a_group, b_group))
        listing = np.zeros(len(a) + len(b), np.int64)
        n = len(self.a_text)
        listing[np.arange(len(a)) + (np.cumsum(b_count) - b_count)[a_group]] = a + n * np.isin(a_end, both, assume_unique=True)
        last = np.isin(b_end, both, assume_unique=True)
        listing[np.arange(len(b)) + np.cumsum(a_count)[b_group]] = b + 2 * n + len(self.b_text) * last
        groups, groups_at = joined(self.names, pa.array(listing), starts_of(n_a + n_b))
        return Aligned(spelled, np.stack([n_a, n_b, np.diff(both_at)], axis=1), links, links_at, groups, groups_at)

    def safe(self, word: str) -> bool:
        """Whether both tokenizers treat the word, with a blank before it, alike in any text."""
        return word[:1] not in ("", "\n") and MARK not in word and not self.bytes.odd.search(word)

    def batch(self, text: pa.Array) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, groups, distinct pairs, how often each) of every text; zeros and b'' where there are no tokens."""
        if len(text) == 0:
            return
        bounds, numbers, distinct = blank_parts(text)
        place = numbers.to_numpy()
        fine = np.array([self.safe(x) for x in distinct], bool) & self.independent
        whole = np.logical_or.reduceat(~fine[place], bounds[:-1])
        # Only words of texts that are put together; their numbers among those.
        wanted = np.zeros(len(distinct), bool)
        wanted[place[~np.repeat(whole, np.diff(bounds))]] = True
        number = np.cumsum(wanted) - 1
        words = self.align([distinct[i] for i in np.flatnonzero(wanted).tolist()], False)
        long = np.flatnonzero(whole).tolist()
        alone = dict(zip(long, range(len(long)), strict=True))
        texts_alone = self.align([text[i].as_py() for i in long], True)
        n_links = np.diff(words.links_at)
        for i in range(len(text)):
            if whole[i]:
                k = alone[i]
                own = texts_alone
                links = own.links[own.links_at[k] : own.links_at[k + 1]]
                groups = bytes(own.groups[own.groups_at[k] : own.groups_at[k + 1]])
                yield (*own.n[k].tolist(), groups[:-1], *np.unique(links, return_counts=True))
                continue
            used = number[place[bounds[i] : bounds[i + 1]]]
            if not words.spelled[used].all():
                yield 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            at = words.groups_at
            groups = b"".join([words.groups[x:y] for x, y in zip(at[used].tolist(), at[used + 1].tolist(), strict=True)])
            n = n_links[used]
            taken = np.arange(n.sum()) + np.repeat(words.links_at[used] - (np.cumsum(n) - n), n)
            yield (*words.n[used].sum(axis=0).tolist(), groups[:-1], *np.unique(words.links[taken], return_counts=True))


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def sums_of(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes, empty ones among them."""
    return np.diff(starts_of(values)[starts_of(sizes)])


MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def aligned_texts(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False) -> DataFrame:
    """(text_key, copies, n_a, n_b, n_groups, n_links, groups_sha256, groups, pairs, times): one row per distinct text.

    ``pairs`` are the text's distinct linked id pairs (a * vocabulary of b + b), ``times`` how many of its links each holds.
    ``groups`` is null unless ``keep_groups``.
    """
    with open(byte_path, encoding="utf-8") as file:
        byte_json = file.read()
    model = read_model(piece_path)
    distinct = docs.select(F.coalesce("text", F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    schema = f"text_key binary, copies bigint, {', '.join(f'{m} bigint' for m in MEASURES)}, groups_sha256 string, groups string, pairs array<bigint>, times array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_json, model)
        for batch in batches:
            rows = list(aligner.batch(texts(batch.column("text"))))
            stops = np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])]).astype(np.int32)
            flat = [np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int64) for k in (4, 5)]
            columns = [
                batch.column("text_key"),
                batch.column("copies"),
                *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                pa.array([int(r[5].sum()) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r[3]).hexdigest() if r[0] else "" for r in rows], pa.string()),
                pa.array([r[3].decode() if keep_groups else None for r in rows], pa.string()),
                *(pa.ListArray.from_arrays(pa.array(stops), pa.array(x, pa.int64())) for x in flat),
            ]
            names = ["text_key", "copies", *MEASURES, "groups_sha256", "groups", "pairs", "times"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return distinct.select(text_key(), "copies", "text").mapInArrow(run, schema)


def text_key() -> Column:
    """SHA-256 of a text; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_key")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, n_linked, is_best): how many links of the corpus hold each id pair, and whether no pair of its B id has more.

    The window over a B id sees one row per A id: the vocabulary bounds it.
    """
    weighted = aligned.selectExpr("copies", "inline(arrays_zip(pairs, times))")
    counts = weighted.groupBy(F.col("pairs").alias("pair")).agg(F.expr("sum(copies * times)").alias("n_linked"))
    return counts.selectExpr("pair", "n_linked", f"n_linked = max(n_linked) OVER (PARTITION BY pair % {b_size}) AS is_best")


def joined_by(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """Left join on a key that ``right`` holds once, where ``rows`` says how many left rows there are at least for the key.

    Keys with more than a thousandth of all rows, a thousand at most, are joined by broadcast; their left rows get null
    keys with numbers of their own in the shuffle that joins the rest.
    """
    values = F.struct(*(c for c in right.columns if c not in (key, rows)))
    is_hot = F.col(rows) > F.lit(max(total // HOT_SHARE, 1))
    hot = right.filter(is_hot).select(F.col(key).alias("_hot_key"), values.alias("_hot"))
    rest = right.filter(~is_hot).select(F.col(key).alias("_key"), F.lit(0).alias("_salt"), values.alias("_rest"))
    marked = left.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    salt = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int"))
    salted = marked.withColumn("_left_salt", salt)
    found = salted.join(rest, (F.col(key) == F.col("_key")) & (F.col("_left_salt") == F.col("_salt")), "left")
    return found.select(*left.columns, F.coalesce("_hot", "_rest").alias("_v")).select(*left.columns, "_v.*")


def aligned_documents(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) of every document.

    A is the byte-level vocabulary of ``byte_path`` on blank and text, B the pieces of ``piece_path`` on the text, whose
    own first marker is that blank. Null and empty texts, and texts that the tokens of either don't spell, have no
    tokens: zeros and ''. Copies count each in the corpus, a null doc_id stays null, repeated rows give repeated rows, other
    columns are left out. A very long text is one row of a batch of its own; a worker holds its links.
    """
    rows = docs.select("doc_id", "text")
    aligned = stored(aligned_texts(rows, byte_path, piece_path, keep_groups), "aligned")
    b_size = piece_count(piece_path)
    counts = stored(pair_counts(aligned, b_size), "pairs")
    n_pairs, n_links = counts.agg(F.count("*"), F.coalesce(F.sum("n_linked"), F.lit(0))).first()
    used = aligned.selectExpr("text_key", "inline(arrays_zip(pairs, times))").withColumnRenamed("pairs", "pair")
    if n_pairs <= BROADCAST_PAIRS:
        measured = used.join(F.broadcast(counts), "pair")
    else:
        own = counts.select("pair", "n_linked", "is_best", F.col("n_linked").alias("_rows"))
        measured = joined_by(used, own, "pair", "_rows", n_links)
    sums = measured.groupBy("text_key").agg(
        F.expr("sum(if(is_best, times, 0L))").alias("n_best"), F.expr("sum(n_linked * times)").alias("count_sum")
    )
    measures = aligned.drop("pairs", "times").join(sums, "text_key", "left")
    by_text = stored(measures.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_best", "count_sum")}), "measures")
    total = by_text.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    keyed = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key())
    return joined_by(keyed, by_text, "text_key", "copies", total).drop("text_key")


def piece_count(piece_path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=piece_path).get_piece_size()
