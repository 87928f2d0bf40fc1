import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from subtally.llm import packing
from tests.llm.texts import HARD, mixed, prose

FILE = path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, start string, bucket int"


def ids_of(text):
    return [*Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_hold_every_id_once_in_power_of_two_sequences(spark, documents):
    texts = [None, *HARD, *mixed(1, 60), prose(1, 3000), prose(2, 9000), HARD[5], HARD[5]]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "unnamed", None, None)]
    pieces = packing.pack(documents(rows, SCHEMA), FILE).toPandas()
    assert pieces["sequence_id"].is_unique
    assert (pieces["offset"] == 0).all()
    assert (pieces["length"] == 2 ** pieces["bucket"]).all() and pieces["length"].max() <= 2048
    assert (pieces["sequence_id"] // 2**58 == pieces["bucket"]).all()
    for i, text in [*enumerate(texts), (None, "unnamed")]:
        own = pieces[pieces["doc_id"].isna()] if i is None else pieces[pieces["doc_id"] == i]
        ids, at = ids_of(text), 0
        for row in own.sort_values("start").itertuples():
            assert row.start == at and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(np.array(ids[at : at + row.length], "<u4").tobytes())
            at += row.length
        assert at == len(ids)


def test_repeated_rows_are_packed_each_and_an_empty_table_gives_none(documents):
    pieces = packing.pack(documents([(1, "same text"), (1, "same text")]), FILE)
    assert pieces.count() == 2 * len(packing.binary_pieces(len(ids_of("same text")), 2048))
    assert packing.pack(documents([], name="none"), FILE).count() == 0


def test_shorter_sequences_and_a_bad_length(documents):
    docs = documents([(1, "one two three four five six")])
    assert {r["length"] for r in packing.pack(docs, FILE, max_length=4).collect()} <= {1, 2, 4}
    with pytest.raises(ValueError):
        packing.pack(docs, FILE, max_length=6)


def test_the_table_of_chunks_may_overflow(monkeypatch):
    import pyarrow as pa

    with open(FILE, encoding="utf-8") as file:
        encoder = packing.ChunkEncoder(file.read())
    monkeypatch.setattr(packing, "TABLE_BYTES", 6000)
    for seed in range(4):
        texts = mixed(seed, 30) + [prose(seed, 30)]
        for text, ids in zip(texts, encoder.batch(pa.array(texts)), strict=True):
            assert ids == np.array(ids_of(text)[:-1], "<u4").tobytes()


def test_without_ranks_the_library_alone_gives_the_same():
    import pyarrow as pa

    with open(FILE, encoding="utf-8") as file:
        encoder = packing.ChunkEncoder(file.read())
    assert encoder.by_rank is not None
    texts = mixed(9, 50)
    quick = list(encoder.batch(pa.array(texts)))
    encoder.by_rank = None
    encoder.table.clear()
    assert list(encoder.batch(pa.array(texts))) == quick
