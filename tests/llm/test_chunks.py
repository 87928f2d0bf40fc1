import random

import numpy as np
import pyarrow as pa
import pytest

from subtally.llm import chunks
from subtally.llm.common import text_bytes
from tests.llm.texts import HARD, mixed, prose


def pieces(text):
    starts, raw = text_bytes(pa.array([text]))
    edges = chunks.cuts(raw, starts)
    return [raw[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def test_chunks_make_up_the_text_and_do_not_depend_on_neighbours():
    texts = [*HARD, *mixed(11, 80, 300), "一二三" * 5000, prose(11, 4000)]
    starts, raw = text_bytes(pa.array(texts))
    edges = set(chunks.cuts(raw, starts).tolist())
    for text, start in zip(texts, starts[:-1].tolist(), strict=True):
        own = pieces(text)
        assert b"".join(own).decode() == text
        assert all(len(p) <= chunks.MOST + 3 and p.decode() is not None for p in own)
        assert {start + k for k in np.cumsum([0, *map(len, own)])[:-1].tolist()} <= edges


def test_an_insertion_moves_only_the_chunks_next_to_it():
    text = prose(12, 3000)
    before, after = pieces(text), pieces(text[:7001] + "a few new words " + text[7001:])
    assert len(set(before) - set(after)) <= 3


def spans(documents, rows, **more):
    return chunks.repeated_passages(documents(rows, "doc_id bigint, text string, start string"), **more).collect()


def test_passages_of_over_fifty_words_are_caught_and_clean_documents_left_alone(documents):
    passages = [prose(100 + k, 52 + k % 30, 10**6) for k in range(40)]
    rows = []
    for k, passage in enumerate(passages):
        for copy in range(2 + k % 3):
            rows.append((10 * k + copy, f"{prose(5000 + 10 * k + copy, 80, 10**6)} {passage} {prose(9000 + 10 * k + copy, 60, 10**6)}", "x"))
    clean = [(100000 + k, prose(20000 + k, 200, 10**6), "x") for k in range(60)]
    texts = {i: t for i, t, _ in rows}
    found = spans(documents, [*rows, *clean])
    assert {r.doc_id for r in found} <= set(texts) and {r.first_doc_id for r in found} <= set(texts)
    caught = {frozenset((r.doc_id, r.first_doc_id)) for r in found}
    missed = 0
    for k, passage in enumerate(passages):
        own = [i for i in texts if i // 10 == k]
        cut = {r.doc_id for r in found if r.doc_id in own}
        assert len(cut) <= len(own) - 1  # the first copy stays
        missed += len(own) - 1 - len(cut)
        for r in found:
            if r.doc_id in own:
                stretch = texts[r.doc_id][r.start : r.end]
                assert stretch.strip() in passage + " " or len(stretch.split()) - len(passage.split()) <= 8
    assert missed <= 1 and len(caught) >= sum(1 + k % 3 for k in range(40)) - 1


def test_what_is_cut_stands_elsewhere(documents):
    copy = prose(31, 120, 10**6)
    within = prose(32, 60, 10**6)
    rows = [(1, copy, "x"), (2, copy, "x"), (None, copy, "x"), (4, f"{within}\n{within}\n{prose(33, 40)}", "x"), (5, None, "x"), *((50 + i, t, "x") for i, t in enumerate(HARD))]
    docs = documents(rows, "doc_id bigint, text string, start string")
    from pyspark.sql import functions as F

    own = docs.select("doc_id", "text", "start", F.monotonically_increasing_id().alias("_row"))
    left = {(r.doc_id, r.start): r.text for r in chunks.cut_out(own, chunks.repeats(own, "_row"), "_row").collect()}
    assert len(left) == len(rows) and left[5, "x"] is None
    copies = [left[k, "x"] for k in (1, 2, None)]
    assert sorted(len(t) for t in copies)[:2] == [0, 0] and copy in copies
    assert len(left[4, "x"]) < len(rows[3][1]) and left[4, "x"].startswith(within)
    for i, text in enumerate(HARD):
        if len((text or "").split()) < 16:
            assert left[50 + i, "x"] == text


def test_phrases_of_different_documents_do_not_make_up_a_passage(documents):
    parts = [pieces(prose(300 + k, 200, 10**6)) for k in range(12)]
    phrases = [next(p for p in part[3:] if 4 <= len(p.split()) <= 9).decode() for part in parts]
    stitched = "".join(phrases)
    assert len(stitched.split()) >= 48
    rows = [(k, b"".join(part).decode(), "x") for k, part in enumerate(parts)]
    # Neighbours stand together in pairs as well, but never 16 words of them.
    rows += [(100 + k, f"{prose(700 + k, 40, 10**6)}\n{a}{b}\n{prose(800 + k, 40, 10**6)}", "x") for k, (a, b) in enumerate(zip(phrases, phrases[1:], strict=False)) if len((a + b).split()) < 16]
    assert spans(documents, [*rows, (1000, f"{prose(950, 60, 10**6)} {stitched}{prose(951, 60, 10**6)}", "x")]) == []


def test_runs_cover_a_passage_from_its_first_whole_chunk_to_its_last(documents):
    passage = prose(41, 150, 10**6)
    texts = [f"{prose(950 + k, 90, 10**6)} {passage} {prose(960 + k, 90, 10**6)}" for k in range(2)]
    own, other = (pieces(t) for t in texts)
    common = [p for p in own if p in set(other)]
    [found] = spans(documents, [(k, t, "x") for k, t in enumerate(texts)])
    assert texts[found.doc_id][found.start : found.end].encode() == b"".join(common)
    assert found.n_words == len(b"".join(common).split())


def letters(seed, n, first, last):
    rng = np.random.default_rng(seed)
    return "".join(chr(c) for c in rng.integers(first, last, n))


def test_passages_without_blanks_are_caught(documents):
    scripts = {"japanese": (0x3041, 0x3097), "chinese": (0x4E00, 0x9FA0), "thai": (0xE01, 0xE2F), "lao": (0xE94, 0xE98), "latin": (0x61, 0x7B)}
    rows, want = [], {}
    for k, (script, span) in enumerate(scripts.items()):
        n = 300
        passage = letters(k, n, *span)
        copies = [passage, passage] if script == "latin" else [f"{letters(50 + 2 * k + i, 200, *span)}{passage}{letters(90 + 2 * k + i, 200, *span)}" for i in range(2)]
        rows += [(10 * k + i, text, "x") for i, text in enumerate(copies)]
        want[k] = passage
    texts = {i: t for i, t, _ in rows}
    found = spans(documents, rows)
    assert sorted(r.doc_id // 10 for r in found) == sorted(want)
    for r in found:
        cut = texts[r.doc_id][r.start : r.end]
        assert cut in want[r.doc_id // 10] and len(cut) >= 200 and r.first_doc_id // 10 == r.doc_id // 10
    assert spans(lambda rows, schema: documents(rows, schema, "clean"), [(k, letters(700 + k, 900, *s), "x") for k, s in enumerate([*scripts.values()] * 2)]) == []


@pytest.mark.parametrize("n", [3_000, 20_000, 200_000])
def test_long_runs_without_blanks_are_caught_behind_any_head(documents, n):
    rng = np.random.default_rng(n)
    symbols = np.array([*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"])
    passage, *heads = ("".join(rng.choice(symbols, k)) for k in (n, 100, 137, 9, 5000))
    rows = [(k, f"{heads[k]}{passage}{heads[-1 - k]}", "x") for k in range(3)]
    cut = {}
    for r in spans(documents, rows):
        own = rows[r.doc_id][1][r.start : r.end]
        assert own in passage
        cut[r.doc_id] = cut.get(r.doc_id, 0) + len(own)
    assert len(cut) == 2 and min(cut.values()) > n - 1200  # the first copy stays


def test_forced_cuts_depend_on_content_too():
    """A long stretch in which the hash opens nothing: cuts behind different heads fall together again."""
    rng = np.random.default_rng(5)
    quiet = ""
    while len(quiet) < 40_000:  # letters that don't end in an opening hash
        part = quiet + "".join(rng.choice([*"abcdef"], 40))
        starts, raw = text_bytes(pa.array([part]))
        upper = chunks.rolling_hash(raw, starts)[max(0, len(quiet) - 1) :]
        quiet = part if not (upper >> np.uint16(16 - chunks.RARER) == 0).any() else quiet
    own, other = pieces("x" * 90 + quiet), pieces("y" * 1117 + quiet)
    assert max(map(len, own)) <= chunks.MOST
    assert len(set(own) & set(other)) >= len(own) // 2


def covered(texts, min_words):
    """By row the characters of every run of whole chunks, long enough, that stands in an earlier row or place."""
    seen, found = set(), {}
    for row, text in enumerate(texts):
        own = pieces(text) if text else []
        starts, raw = text_bytes(pa.array([text or ""]))
        words = chunks.sizes(raw, starts)
        at = np.cumsum([0, *map(len, own)])
        fresh = []
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                if words[at[j]] - words[at[i]] >= chunks.UNIT * min_words or at[j] - at[i] >= chunks.WORD_BYTES * min_words:
                    run = b"".join(own[i:j])
                    if run in seen:
                        first = len(raw[: at[i]].tobytes().decode())
                        found.setdefault(row, set()).update(range(first, first + len(run.decode())))
                    seen.add(run)
                    fresh.append(run)
    return found


def test_repeats_are_those_of_all_runs(documents):
    rng = random.Random(13)
    shared = [prose(60 + k, rng.choice([18, 30, 45]), 10**6) for k in range(6)] + ["一二三四五六七八九十" * 4, "b64" * 120]
    texts = [" ".join(rng.choice([rng.choice(shared), prose(rng.random(), rng.randint(1, 25), 10**6)]) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    texts += ["", None, texts[3], f"{shared[0]} {shared[0]}"]
    docs = documents([(k, t) for k, t in enumerate(texts)])
    got = {}
    for r in chunks.repeats(docs.withColumnRenamed("doc_id", "_own"), "_own").collect():
        got.setdefault(r.row, set()).update(range(r.start, r.end))
    assert got == covered(texts, 16)


def test_columns_with_the_operators_own_names(documents):
    copy = prose(71, 90, 10**6)
    rows = [(k, copy, 5, "a", 6, 7, "b") for k in (1, 2)]
    docs = documents(rows, "doc_id bigint, text string, _row int, _path string, _place int, _number int, _file string")
    [found] = chunks.repeated_passages(docs).collect()
    assert (found.doc_id, found.first_doc_id) in {(1, 2), (2, 1)}


def test_empty_table(documents):
    assert spans(documents, []) == []
