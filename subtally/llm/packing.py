"""Packing by power-of-two decomposition: pieces of binary lengths, bucketed by length, none shared by documents."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import blank_parts, joined, lean, texts

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, bucket int"
# Bytes of a table of distinct chunks: beyond, it starts afresh with the next batch of texts, which only costs time.
TABLE_BYTES = 192 << 20
ENTRY_BYTES = 220  # of an entry besides its texts and ids
# Stands for the ids of a blank-led chunk that could depend on its neighbours: the library gets the whole text.
UNSAFE = b"?"
# Fixed value: the public split pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as code points from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ChunkEncoder:
    """ids as little-endian unsigned 32-bit bytes, exactly those of the tokenizer on the whole text.

    The pre-tokenizer always cuts before a blank that stands alone before a word, so each distinct blank-led chunk of
    a text is encoded once and joined by position. Where every merge makes the next id, merging by lowest id is the
    same procedure, and new chunks go through the faster of the two libraries that do it.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.odd = re.compile("|".join([r"[^\S \n]", *map(re.escape, self.special)]))
        self.by_rank = self.ranked(json.loads(tokenizer_json))
        self.table: dict[str, bytes] = {}
        self.held = 0

    def ranked(self, spec: dict):
        """An encoder by rank, or None where the vocabulary isn't plain byte-level BPE in order of its merges."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and not spec.get("normalizer")
        if not plain or split.get("add_prefix_space") or split.get("use_regex") is False or model.get("ignore_merges"):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        symbols = byte_of_symbol()
        ranks = {bytes(symbols[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        if sorted(ranks.values()) != list(range(256 + len(merges))):
            return None
        import tiktoken

        self.lengths = np.zeros(len(ranks), np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, documents: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(documents, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def chunks(self, parts: list[str]) -> list[bytes]:
        """Ids of " " + part for each part; all are safe, so one text of them all falls apart at their ends."""
        if self.by_rank is None or not parts:
            return self.whole([" " + x for x in parts])
        ids = np.array(self.by_rank.encode_ordinary(" " + " ".join(parts)), "<u4")
        ends = np.cumsum([1 + len(x.encode()) for x in parts])
        cuts = 4 * np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="right")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]

    def fill(self, missing: list[str]) -> None:
        if self.odd.search(" ".join(missing)):
            unsafe = {x for x in missing if x[:1] in ("", "\n") or self.odd.search(x)}
        else:
            unsafe = {x for x in missing if x[:1] in ("", "\n")}
        safe = [x for x in missing if x not in unsafe] if unsafe else missing
        found = self.chunks(safe)
        self.table.update(zip(safe, found, strict=True))
        self.table.update(dict.fromkeys(unsafe, UNSAFE))
        # A chunk in Python takes up to four bytes a character.
        self.held += sum(map(len, found)) + 4 * sum(map(len, missing)) + ENTRY_BYTES * len(missing)

    def batch(self, text: pa.Array) -> Iterator[bytes]:
        bounds, numbers, distinct = blank_parts(text)
        values = list(map(self.table.get, distinct))
        missing = [x for x, value in zip(distinct, values, strict=True) if value is None]
        if missing:
            if self.held > TABLE_BYTES:
                self.table.clear()
                self.held, missing = 0, distinct
            self.fill(missing)
            values = list(map(self.table.__getitem__, distinct))
        flags = np.fromiter((x is UNSAFE for x in values), bool, len(values))[numbers.to_numpy()]
        whole = np.logical_or.reduceat(flags, bounds[:-1]) if len(text) else []
        heads = numbers.to_numpy()[bounds[:-1]].tolist()
        firsts = self.whole([text[i].as_py() if w else distinct[h] for i, (w, h) in enumerate(zip(whole, heads, strict=True))])
        data, places = joined(values, numbers, bounds)
        starts = places.tolist()
        for i, (first, w) in enumerate(zip(firsts, whole, strict=True)):
            yield first if w else first + data[starts[i] + len(values[heads[i]]) : starts[i + 1]]


def binary_pieces(tokens: int, most: int) -> list[int]:
    """Full sequences first, then the binary digits of the rest, longest first."""
    rest = tokens % most
    return [most] * (tokens // most) + [1 << k for k in range(most.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, max_length: int = 2048) -> DataFrame:
    """One row per piece; every piece is a sequence of its own whose length is a power of two, so nothing is padded.

    ``bucket`` is the base-2 logarithm of the length. Sequence ids carry it in their highest bits, so equal
    lengths lie next to each other: batches of one shape are ranges of ids. A null or empty text is the end id
    alone; a null doc_id stays null; repeated rows are packed each. Only doc_id and text are read, texts of
    any length whole. There is no
    shuffle: ids are numbered within the input's partitions, so ``docs`` must be a stored table.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer_json)
        part, used = TaskContext.get().partitionId(), [0] * max_length.bit_length()
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.batch(texts(batch.column("text"))), strict=True):
                ids += end
                start, total = 0, len(ids) // 4
                for length in binary_pieces(total, max_length):
                    bucket = length.bit_length() - 1
                    sequence = bucket << 58 | part << 34 | used[bucket]
                    used[bucket] += 1
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for column, value in zip(columns, (doc_id, start, length, crc, total, sequence, 0, bucket), strict=True):
                        column.append(value)
                    start += length
            kinds = [pa.int64()] * 7 + [pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(lean(run), SCHEMA)
