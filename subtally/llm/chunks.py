"""Substring dedup by content-defined chunking: a gear rolling hash cuts texts, runs of chunks are deduplicated by digest.

A cut depends on the sixteen bytes before it and on the cuts just before, so an insertion moves the chunks next to it
only. Cuts lie at word starts (for scripts without blanks, at characters), and inside a word only where it is longer
than words are: encoded data, minified code, long numbers.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtally.llm.common import lean, numbered, stored, text_bytes, texts

WINDOW = 16  # bytes that the 16-bit rolling hash sees
RARITY = 2  # a word start is a cut where so many upper bits of the hash are zero: one in four
# Past so many bytes without a place to cut, any character may be one, where more of the upper bits are zero: one in 64.
ENDLESS, RARER = 64, 6
LEAST, MOST = 12, 4096  # bytes of a chunk; at the end of a text it may be shorter
GEAR = np.random.default_rng(20240229).integers(0, 1 << 16, 256, np.uint16)
BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
# Lead bytes of the scripts written without blanks (from U+3000) and of everything beyond the basic plane.
WIDE = np.arange(256) >= 0xE3
# Without blanks characters stand for words: UNIT is one, an ideograph one, kana half of one, and a quarter each letter
# of Thai, Lao, Tibetan, Burmese and Khmer (by code point, without the marks above and below).
UNIT = 4
SIZE = np.select([np.arange(256) == 0xE3, (np.arange(256) >= 0xE4) & (np.arange(256) <= 0xE9)], [2, UNIT], 0).astype(np.int8)
LETTERS = np.zeros(0x2000, bool)
LETTERS[[c for c in (*range(0xE00, 0x10A0), *range(0x1780, 0x1800)) if unicodedata.category(chr(c))[0] == "L"]] = True
WORD_BYTES = 16  # so many bytes for each word asked for are long as well, whatever they are made of


def loose_letters(raw: np.ndarray) -> np.ndarray:
    """Marks the first byte of each character in LETTERS."""
    at = np.flatnonzero((raw == 0xE0) | (raw == 0xE1))
    code = (raw[at].astype(np.int64) & 0xF) << 12
    for k in (1, 2):
        code |= (raw[at + k].astype(np.int64) & 0x3F) << 6 * (2 - k)
    found = np.zeros(len(raw), bool)
    found[at] = LETTERS[code]
    return found


def sizes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words before every byte and before the end, in units of a quarter: a word counts where it starts."""
    blank = BLANK[raw]
    first_of_text = np.zeros(len(raw), bool)
    first_of_text[starts[:-1][np.diff(starts) > 0]] = True
    opens = ~blank & (np.concatenate([[True], blank[:-1]])[: len(raw)] | first_of_text)
    own = np.maximum(SIZE[raw], loose_letters(raw))
    own[:-1][(raw[:-1] == 0xF0) & (raw[1:] >= 0xA0)] = UNIT  # the rarer ideographs
    return np.concatenate([[0], np.cumsum(np.maximum(own, np.int8(UNIT) * opens), dtype=narrow(raw))])


def narrow(raw: np.ndarray) -> type:
    """The smaller type that counts of quarters over all bytes fit."""
    return np.int32 if len(raw) < (1 << 31) // UNIT else np.int64


def rolling_hash(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of gear values shifted by their distance over the last sixteen bytes of the same text, at every byte."""
    value = GEAR[raw]
    width = 1
    while width < WINDOW:
        shifted = value[:-width] << np.uint16(width)
        value[width:] += shifted
        width *= 2
    # What reached over from the text before: the sum at its end, shifted on. All sums are of the bytes as they lie.
    inner = starts[1:-1][(starts[1:-1] > 0) & (starts[1:-1] < len(raw))]
    over = value[inner - 1]
    inner, first = np.unique(inner, return_index=True)
    over = over[first]
    ends = np.append(inner[1:], len(raw))
    for k in range(min(WINDOW - 1, len(raw))):
        there = inner + k < ends
        value[inner[there] + k] -= over[there] << np.uint16(k + 1)
    return value


def openings(raw: np.ndarray) -> np.ndarray:
    """Marks the bytes at which a chunk may begin as a rule: word starts, and characters of scripts without blanks."""
    blank = BLANK[raw]
    opens = WIDE[raw] | loose_letters(raw)
    opens[1:] |= blank[:-1] & ~blank[1:]
    return opens


def cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ascending places at which a chunk begins; each text's start is one, and the end of all is the last."""
    if not len(raw):
        return np.unique(starts)
    opens = openings(raw)
    upper = np.zeros(len(raw), np.uint16)  # of the sixteen bytes before
    upper[1:] = rolling_hash(raw, starts)[:-1]
    chosen = opens & (upper >> np.uint16(16 - RARITY) == 0)
    opens[starts[:-1][np.diff(starts) > 0]] = True
    last = np.maximum.accumulate(np.where(opens, np.arange(len(raw), dtype=np.int32 if len(raw) < 1 << 31 else np.int64), 0))
    endless = np.flatnonzero((upper >> np.uint16(16 - RARER) == 0) & ~opens & ((raw & 0xC0) != 0x80))
    chosen[endless[endless - last[endless] >= ENDLESS]] = True
    chosen[0] = False
    found = np.unique(np.concatenate([np.flatnonzero(chosen), starts]))
    # A cut too close to the one before goes; this looks at its own surroundings only, whatever lies further ahead.
    edge = np.isin(found, starts)
    near = np.concatenate([[False], np.diff(found) < LEAST])
    found = found[edge | ~near]
    gaps = np.diff(found)
    forced = []
    for a, b in zip(found[:-1][gaps > MOST].tolist(), found[1:][gaps > MOST].tolist(), strict=True):
        while b - a > MOST:  # the last resort: of the second half of what a chunk may have, the character after the least hash
            own = np.where((raw[a + MOST // 2 : a + MOST] & 0xC0) != 0x80, upper[a + MOST // 2 : a + MOST].astype(np.int32), 1 << 16)
            a += MOST // 2 + int(own.argmin())
            forced.append(a)
    return np.unique(np.concatenate([found, np.array(forced, np.int64)])) if forced else found


def long_runs(edges: np.ndarray, ends: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of whole chunks of one text that are just long enough: (places in ``edges`` where they begin, where they end).

    From every chunk the shortest run on that has ``min_words`` words or WORD_BYTES times as many bytes, and to every
    chunk the shortest one back. Runs depend on their chunks only, and those within a longer run of chunks cover all of
    it. ``ends`` has for each chunk the place where its text ends, ``words`` what ``sizes`` counts before each place.
    """
    n = len(edges) - 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.arange(n)
    measures = ((words, UNIT * min_words), (edges, WORD_BYTES * min_words))
    on = np.min([np.searchsorted(m, m[:-1] + least) for m, least in measures], axis=0)
    inside = on <= ends
    last = np.arange(1, n + 1)
    back = np.max([np.searchsorted(m, m[1:] - least, side="right") - 1 for m, least in measures], axis=0)
    opening = np.concatenate([[0], np.flatnonzero(np.diff(ends)) + 1])  # first chunk of each text
    begin = opening[np.searchsorted(opening, first, side="right") - 1]
    fits = back >= begin
    runs = np.unique(np.concatenate([first[inside] * (n + 1) + on[inside], back[fits] * (n + 1) + last[fits]]))
    return runs // (n + 1), runs % (n + 1)


def run_rows(docs: DataFrame, row_id: str, min_words: int) -> DataFrame:
    """(row, start, end, word, n_words, again, high, low): every run of ``long_runs`` with its 128-bit digest.

    Start and end count characters, ``word`` the words before, these and n_words in units; ``again`` marks a run whose like stands earlier in the
    same text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            starts, raw = text_bytes(texts(batch.column("text")))
            edges = cuts(raw, starts)
            owner = np.searchsorted(starts, edges[:-1], side="right") - 1
            characters = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=narrow(raw))])
            words = sizes(raw, starts)
            ends = np.searchsorted(edges, starts[owner + 1])
            left, right = long_runs(edges, ends, words[edges], min_words)
            whole, begins, stops, owner = raw.tobytes(), edges[left], edges[right], owner[left]
            names = [digest(whole[a:b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
            seen: set[bytes] = set()
            again, last = [], -1
            for name, text in zip(names, owner.tolist(), strict=True):
                if text != last:
                    seen, last = set(), text
                again.append(name in seen)
                seen.add(name)
            halves = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            base = characters[starts[owner]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(owner)),
                    pa.array((characters[begins] - base).astype(np.int32)),
                    pa.array((characters[stops] - base).astype(np.int32)),
                    pa.array((words[begins] - words[starts[owner]]).astype(np.int32)),
                    pa.array((words[stops] - words[begins]).astype(np.int32)),
                    pa.array(again, pa.bool_()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                ],
                ["row", "start", "end", "word", "n_words", "again", "high", "low"],
            )

    schema = "row bigint, start int, end int, word int, n_words int, again boolean, high bigint, low bigint"
    return docs.select(F.col(row_id).alias("row"), "text").mapInArrow(lean(run), schema)


def repeats(docs: DataFrame, row_id: str, min_words: int = 16) -> DataFrame:
    """(row, start, end, n_words, first_row): stretches of a text that stand earlier, in characters.

    A run of neighbouring chunks with at least ``min_words`` words (see UNIT) or sixteen times as many bytes repeats if it stands as one run in a smaller row or
    before in the same one; what is shorter is chance or boilerplate too short to cut. Of equal runs the one in the
    smallest row and there the first stays. Overlapping runs form one stretch, whose ``first_row`` has the text that
    keeps its first run. ``row_id`` is a long that is unique in a stored table; null and empty texts have no chunk. A text of
    any length is cut whole by one task; its runs are rows of their own.
    """
    runs = run_rows(docs, row_id, min_words)
    known = runs.groupBy("high", "low").agg(F.min("row").alias("first_row"), F.count("*").alias("n")).filter("n > 1").drop("n")
    found = runs.join(known, ["high", "low"]).filter("again OR row <> first_row")
    order = Window.partitionBy("row").orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.when(F.max("end").over(before) > F.col("start"), 0).otherwise(1)
    stretches = found.withColumn("fresh", fresh).withColumn("stretch", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.expr(f"CAST((max(word + n_words) - min(word)) DIV {UNIT} AS INT)").alias("n_words")
    ends = (F.min("start").alias("start"), F.max("end").alias("end"))
    return stretches.groupBy("row", "stretch").agg(*ends, words, F.min_by("first_row", F.struct("start", "end")).alias("first_row")).drop("stretch")


def cut_out(docs: DataFrame, spans: DataFrame, row_id: str) -> DataFrame:
    """The rows with the stretches (row, start, end) taken out of their texts; all other columns stay as they are."""
    by_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    joined = docs.join(by_row, docs[row_id] == by_row["row"], "left").drop("row")
    schema = T.StructType([*docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("_spans").to_pylist()):
                if spans:
                    kept, at = [], 0
                    for span in spans:
                        kept.append(own[i][at : span["start"]])
                        at = max(at, span["end"])
                    own[i] = "".join(kept) + own[i][at:]
            columns = [pa.array(own, pa.string()) if c == "text" else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.select(*(docs[c] for c in schema.names), "_spans").mapInArrow(lean(run), schema)


def repeated_passages(docs: DataFrame, min_words: int = 16) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc_id) of every stretch that ``repeats`` finds.

    Other columns are left out; a null doc_id stays null. Rows are named by file and place in it, so ``docs`` should be a
    stored table; another one is stored first.
    """
    own = numbered(docs.select("doc_id", "text"))
    spans = stored(repeats(own, "_row", min_words), "repeats")
    ids = own.select(F.col("_row"), "doc_id")
    return (
        spans.join(ids.withColumnRenamed("_row", "row"), "row")
        .join(ids.select(F.col("_row").alias("first_row"), F.col("doc_id").alias("first_doc_id")), "first_row")
        .select("doc_id", "start", "end", "n_words", "first_doc_id")
    )
