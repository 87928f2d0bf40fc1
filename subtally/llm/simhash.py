"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that agree in all but r of their 64 bits agree entirely in at least two of r + 2 blocks of bits. Each
pair of blocks is a table whose equal keys meet in one group, so no link is missed. Within a group the fingerprints lie
as bit planes: one machine word holds one bit of 64 fingerprints, a bitwise counter adds up 64 distances at once, and
words are given up as soon as all their distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtally.llm.common import lean, split_words, stored, text_bytes, texts
from subtally.llm.components import components

SEED = 42
BITS = 64
# Shingles whose bits are spread out at once, and fingerprints that are compared at once.
SLICE, STRETCH = 1 << 17, 1 << 17
# Groups of more fingerprints are dealt over pairs of pages of about this size.
PAGE = 8192


def shingle_hashes(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of a batch of lower-cased texts, and the text that each belongs to."""
    bounds, words = split_words(text)
    lengths = np.diff(bounds)
    starts, raw = text_bytes(words)
    # All words again, one blank after each: shingles are then stretches of one buffer.
    ends = np.cumsum(np.diff(starts) + 1)
    buffer = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    buffer[np.arange(len(raw)) + np.repeat(np.arange(len(words)), np.diff(starts))] = raw
    begins = np.concatenate([[0], ends])
    shingles = np.where(lengths > 0, np.maximum(lengths - width + 1, 1), 0)
    document = np.repeat(np.arange(len(text)), shingles)
    first = np.arange(len(document)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + bounds[document]
    last = np.minimum(first + width, bounds[document + 1])
    whole, digest = buffer.tobytes(), xxhash.xxh64_intdigest
    found = np.empty(len(document), np.uint64)
    for at in range(0, len(document), SLICE):  # places as Python numbers take several times the texts
        pairs = zip(begins[first[at : at + SLICE]].tolist(), (begins[last[at : at + SLICE]] - 1).tolist(), strict=True)
        found[at : at + SLICE] = [digest(whole[a:b], SEED) for a, b in pairs]
    return found, document


def bits_of(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each value, lowest bit first."""
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints_of(text: pa.Array, width: int) -> np.ndarray:
    hashes, document = shingle_hashes(pc.ascii_lower(text), width)
    ones = np.zeros((len(text), BITS), np.int64)
    for at in range(0, len(hashes), SLICE):
        own = document[at : at + SLICE]
        edges = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[edges]] += np.add.reduceat(bits_of(hashes[at : at + SLICE]), edges, axis=0, dtype=np.int64)
    more = 2 * ones > np.bincount(document, minlength=len(text))[:, None]
    return np.packbits(more, axis=1, bitorder="little").reshape(-1).view(np.int64)


def fingerprints(docs: DataFrame, *keep: str, width: int = 4) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long; 0 for a text without a word or a null text.

    Repeated rows have a fingerprint each. A text of any length is hashed whole, its shingles in slices.
    """
    schema = T.StructType([*docs.select(*keep).schema, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(texts(batch.column("_text")), width)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.int64())], [*keep, "fp"])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(lean(run), schema)


def table_keys(radius: int, clean: int = 2) -> list[Column]:
    """A key for each choice of ``clean`` out of radius + clean blocks of bits: the blocks' bits and the choice's number."""
    blocks = radius + clean
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), clean)):
        key = F.lit(number).cast("bigint")
        for k in chosen:
            size = edges[k + 1] - edges[k]
            part = F.shiftrightunsigned("fp", edges[k]).bitwiseAND(F.lit((1 << size) - 1))
            key = F.shiftleft(key, size).bitwiseOR(part)
        keys.append(key)
    return keys


def flatten(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def linked(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as places) that connect what is within the radius in each group; groups are adjacent, fps uint64.

    Row i is compared with row i + lag for one lag after another, all rows at once. Rows known to be connected are not
    compared again, so a group of n gives n - 1 links at most.
    """
    n = len(fps)
    words = (n + 63) // 64
    planes = np.zeros((BITS, 8 * (words + 1)), np.uint8)
    packed = np.packbits(bits_of(fps), axis=0, bitorder="little").T
    planes[:, : packed.shape[1]] = packed
    planes = planes.view(np.uint64)
    parent = np.arange(n)
    found: list[tuple[int, int]] = []
    active = np.arange(n)
    lag = 0
    while True:
        lag += 1
        active = active[active + lag < n]
        active = active[group[active] == group[active + lag]]
        if not len(active):
            break
        compared = active[parent[active] != parent[active + lag]]
        mask = np.zeros(words * 64, bool)
        mask[compared] = True
        alive = np.packbits(mask, bitorder="little").view(np.uint64)
        at = np.flatnonzero(alive)
        alive = alive[at]
        skip, shift = divmod(lag, 64)
        lead, back = np.uint64(shift), np.uint64(64 - shift)
        count = [np.zeros(len(at), np.uint64) for _ in range(radius.bit_length() + 1)]
        for plane in range(BITS):
            if not len(at):
                break
            own = planes[plane]
            other = own[np.minimum(at + skip, words)]
            if shift:
                other = (other >> lead) | (own[np.minimum(at + skip + 1, words)] << back)
            carry = own[at] ^ other
            # The highest digit, once set, stays: such a distance exceeds the radius whatever follows.
            for digit in range(len(count) - 1):
                count[digit], carry = count[digit] ^ carry, count[digit] & carry
            count[-1] |= carry
            if plane % 8 == 7:
                left = alive & ~above(count, radius)
                if not left.all():
                    full = left != 0
                    at, alive, count = at[full], left[full], [c[full] for c in count]
                else:
                    alive = left
        if not len(at):
            continue
        place, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        for i in (at[place] * 64 + bit).tolist():
            a, b = i, i + lag
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((i, i + lag))
        parent = flatten(parent)
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Bitwise: which of the counters (binary digits, the last one sticky) are greater than the radius."""
    greater, equal = count[-1].copy(), ~count[-1]
    for digit in range(len(count) - 2, -1, -1):
        if radius >> digit & 1:
            equal &= count[digit]
        else:
            greater |= equal & count[digit]
            equal &= ~count[digit]
    return greater


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all that are within the radius.

    Groups of more than PAGE fingerprints are dealt over pairs of pages, so no task gets more than two pages of one
    group at once; every two members still meet.
    """
    keyed = fps.select(F.explode(F.array(*table_keys(radius))).alias("key"), "fp")
    large = keyed.groupBy("key").count().filter(F.col("count") > PAGE).select("key", F.ceil(F.col("count") / PAGE).cast("int").alias("pages"))
    page = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("pages")).cast("int")
    other = F.explode(F.expr("CASE WHEN pages IS NULL THEN array(-1) ELSE filter(sequence(0, pages - 1), x -> x <> page) END"))
    dealt = (
        keyed.join(large, "key", "left")
        .withColumn("page", page)
        .select("key", "page", "fp", other.alias("other"))
        .select("key", F.least("page", "other").alias("low"), F.greatest("page", "other").alias("high"), "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            waiting.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "low", "high", "fp")]))
            if sum(x.shape[1] for x in waiting) >= STRETCH:
                rows = np.concatenate(waiting, axis=1)
                same = (rows[:3] == rows[:3, -1:]).all(0)
                cut = int(np.argmax(same))  # the last group may go on
                waiting = [rows[:, cut:]]
                yield from compared(rows[:, :cut])
        if waiting:
            yield from compared(np.concatenate(waiting, axis=1))

    def compared(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if rows.shape[1] < 2:
            return
        same = (rows[:3, 1:] == rows[:3, :-1]).all(0)
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        group = np.cumsum(np.concatenate([[0], ~same]))[shared]
        own = rows[3, shared].astype(np.int64)
        a, b = linked(own.view(np.uint64), group, radius)
        yield pa.RecordBatch.from_arrays([pa.array(own[a], pa.int64()), pa.array(own[b], pa.int64())], ["a", "b"])

    grouped = dealt.select("key", F.coalesce("low", F.lit(-1)).alias("low"), F.coalesce("high", F.lit(-1)).alias("high"), "fp")
    return grouped.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(lean(run), "a bigint, b bigint")


def near_duplicates(prints: DataFrame, radius: int = 4, by_root: bool = False) -> DataFrame:
    """Adds ``component_id`` to rows with doc_id and fp: the smallest doc_id reachable over links, itself included.

    Null doc_ids never are the smallest, unless a component has no other; then its component_id is null. Equal
    fingerprints are linked, so repeated rows share a component. With ``by_root`` the component is named by one of its
    fingerprints instead, in a column ``root``, which is never null.
    """
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    if by_root:
        return prints.join(rooted.select("fp", "root"), "fp")
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp")
