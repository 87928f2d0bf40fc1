"""SentencePiece encoding and decoding through a table of distinct marked words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import blank_parts, joined, texts

MARK = "▁"
# Bytes of a table of distinct chunks: beyond, it starts afresh with the next batch of texts, which only costs time.
TABLE_BYTES = 192 << 20
ENTRY_BYTES = 330  # of an entry besides its texts and ids


def chunks_are_independent(model: bytes) -> bool:
    """True if no piece crosses a whitespace marker and the text reaches the segmenter unchanged but for the markers."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model).normalizer_spec
    if not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces or spec.precompiled_charsmap:
        return False
    processor = SentencePieceProcessor(model_proto=model)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    return not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in pieces)


class ChunkTable:
    """Ids and decoded text of each distinct chunk (a run of markers and the word after it), computed once.

    A chunk is named by the text whose encoding it is: the marker that the model puts before every text stands for
    the chunk's first one.
    """

    def __init__(self, model: bytes, independent: bool):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        self.independent = independent
        self.end = self.processor.eos_id()
        self.guard = self.processor.encode("a")
        self.guarded = len(self.processor.decode(self.guard))
        self.decimal = [str(i) for i in range(self.processor.get_piece_size())]
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        self.held = 0
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def encode(self, chunks: list[str]) -> list[list[int]]:
        found = self.processor.encode(chunks, out_type=int, num_threads=1)
        if "" in chunks:  # the marker alone, at the end of a text
            found[chunks.index("")] = [self.processor.piece_to_id(MARK)]
        return found

    def names(self, text: str) -> list[str]:
        if MARK in text:
            text = text.replace(MARK, " ")
        if not text:
            return []
        names = text.split(" ")
        if "" in names:
            marked = MARK + text.replace(" ", MARK)
            names = [x[1:].replace(MARK, " ") for x in self.cut.findall(marked)]
        return names

    def decode(self, chunks: list[str], found: list[list[int]]) -> list[str]:
        """Each chunk's text with the blank that its first marker stands for."""
        plain = [ids for x, ids in zip(chunks, found, strict=True) if " " not in x]
        parts = self.processor.decode([*self.guard, *chain.from_iterable(plain)])[self.guarded :].split(" ")[1:]
        if len(parts) == len(chunks):
            return [" " + x for x in parts]
        return [x[self.guarded :] for x in self.processor.decode([self.guard + ids for ids in found], num_threads=1)]

    def fill(self, missing: list[str]) -> None:
        if not missing:
            return
        found = self.encode(missing)
        name = self.decimal.__getitem__
        ids = [(" ".join(map(name, x)) + " ").encode() for x in found]
        decoded = [x.encode() for x in self.decode(missing, found)]
        self.ids.update(zip(missing, ids, strict=True))
        self.decoded.update(zip(missing, decoded, strict=True))
        # A chunk in Python takes up to four bytes a character, its decoded text is as long.
        self.held += sum(map(len, ids)) + 3 * sum(map(len, decoded)) + ENTRY_BYTES * len(ids)

    def batch(self, text: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """(decimal ids joined by blanks, decoded UTF-8) of each text."""
        if not self.independent:
            for x in text.to_pylist():
                ids = [*self.processor.encode(x), self.end]
                yield " ".join(map(str, ids)).encode(), self.processor.decode(ids).encode()
            return
        last = b"%d" % self.end
        bounds, numbers, distinct = blank_parts(text)
        # A text with blanks side by side or at an end, or with the marker itself, is cut by the pattern instead.
        flags = np.array([not x or MARK in x for x in distinct], bool)[numbers.to_numpy()]
        odd = np.logical_or.reduceat(flags, bounds[:-1]) if len(text) else []
        named = {i: self.names(text[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        wanted = list({*distinct}.union(*named.values())) if named else distinct
        missing = [x for x in wanted if x not in self.ids]
        if self.held > TABLE_BYTES:
            self.ids.clear()
            self.decoded.clear()
            self.held, missing = 0, wanted
        self.fill([x for x in missing if " " not in x])
        self.fill([x for x in missing if " " in x])
        ids, at = joined(list(map(self.ids.__getitem__, distinct)), numbers, bounds)
        decoded, by = joined(list(map(self.decoded.__getitem__, distinct)), numbers, bounds)
        at, by = at.tolist(), by.tolist()
        for i in range(len(text)):
            if i in named:
                yield b"".join(map(self.ids.__getitem__, named[i])) + last, b"".join(map(self.decoded.__getitem__, named[i]))[1:]
            else:
                yield bytes(ids[at[i] : at[i + 1]]) + last, bytes(decoded[by[i] + 1 : by[i + 1]])


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_decode(docs: DataFrame, model_path: str, digests_only: bool = False) -> DataFrame:
    """(doc_id, ids, decoded, n_tokens, ids_sha256, decoded_sha256) of every whole text; ``ids`` end with the end id.

    Ids and decoded text are those of the library on the whole text. The table of distinct chunks is one per task and
    bounded. A null text counts as empty; a null doc_id stays null; repeated rows give repeated rows. A text of any length is encoded whole, in a batch of its own
    where it fills one. With ``digests_only`` the columns ids and decoded are null: they are made and digested, but don't leave the task.
    """
    model = read_model(model_path)
    independent = chunks_are_independent(model)
    schema = "doc_id bigint, ids string, decoded string, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model, independent)
        for batch in batches:
            found = list(table.batch(texts(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([None if digests_only else a for a, _ in found], pa.binary()).cast(pa.string()),
                    pa.array([None if digests_only else b for _, b in found], pa.binary()).cast(pa.string()),
                    pa.array([a.count(b" ") + 1 for a, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(a).hexdigest() for a, _ in found], pa.string()),
                    pa.array([hashlib.sha256(b).hexdigest() for _, b in found], pa.string()),
                ],
                ["doc_id", "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, decoded) of rows (doc_id, ids), ids as decimal numbers joined by blanks; null or empty ids give ''."""
    model = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_proto=model)
        for batch in batches:
            decoded = [processor.decode([int(i) for i in x.split()]) for x in texts(batch.column("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.string())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, decoded string")
