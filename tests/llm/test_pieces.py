import hashlib
import random

import pyarrow as pa
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor

from subtally.llm import pieces
from tests.llm.texts import HARD, mixed, prose

FILE = path("piece_bpe_32k.model")


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_ids_and_decoded_text_are_the_librarys(documents):
    library = SentencePieceProcessor(model_file=FILE)
    texts = [None, *HARD, *mixed(3, 80), prose(3, 2000)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "unnamed", "y"), (0, None, "again")]
    found = pieces.encode_decode(documents(rows, "doc_id bigint, text string, ids string"), FILE)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect())
    want = []
    for i, text, _ in rows:
        ids = [*library.encode(text or ""), library.eos_id()]
        line, decoded = " ".join(map(str, ids)), library.decode(ids)
        want.append((i is None, i or 0, line, decoded, len(ids), digest(line.encode()), digest(decoded.encode())))
    assert got == sorted(want)


def test_decode_alone_and_digests_alone(documents):
    docs = documents([(1, "some text  here\nand there"), (2, None)])
    full = pieces.encode_decode(docs, FILE)
    assert {r.doc_id: r.decoded for r in pieces.decode(full, FILE).collect()} == {1: "some text  here\nand there", 2: ""}
    slim = pieces.encode_decode(docs, FILE, digests_only=True)
    assert {(r.ids, r.decoded) for r in slim.collect()} == {(None, None)}
    assert sorted(r.ids_sha256 for r in slim.collect()) == sorted(r.ids_sha256 for r in full.collect())


def test_a_model_whose_pieces_may_cross_markers_takes_whole_texts():
    model = pieces.read_model(FILE)
    assert pieces.chunks_are_independent(model)
    texts = pa.array(mixed(4, 40))
    assert list(pieces.ChunkTable(model, False).batch(texts)) == list(pieces.ChunkTable(model, True).batch(texts))


def test_the_table_may_overflow(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_BYTES", 3000)
    model = pieces.read_model(FILE)
    small, large = pieces.ChunkTable(model, True), pieces.ChunkTable(model, False)
    for seed in range(3):
        texts = pa.array([prose(seed, 40), *mixed(seed, 10)])
        assert list(small.batch(texts)) == list(large.batch(texts))


def test_the_table_is_bounded_by_bytes():
    """Long texts without blanks are chunks of many bytes each."""
    table = pieces.ChunkTable(pieces.read_model(FILE), True)
    rng = random.Random(2)
    wide = ["".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(1000)) for _ in range(20)]
    list(table.batch(pa.array(wide)))
    one = table.held
    real = sum(len(k.encode("utf-16")) + len(v) for part in (table.ids, table.decoded) for k, v in part.items())
    assert one >= real
    pieces_limit, pieces.TABLE_BYTES = pieces.TABLE_BYTES, one
    try:
        for k in range(5):
            list(table.batch(pa.array([f"{k}{x}" for x in wide])))
            assert table.held <= 2 * one + 100_000 and len(table.ids) <= 2 * len(wide)
    finally:
        pieces.TABLE_BYTES = pieces_limit


def test_an_empty_table(documents):
    assert pieces.encode_decode(documents([]), FILE).count() == 0
