"""What several operators share: session settings, stored tables, words of a batch of texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subtally.session import prepare, shared_dir

# Bounds the memory of a Python worker: a batch holds as many rows and about as many bytes at most.
BATCH_ROWS, BATCH_BYTES = "1000", "16m"


def prepared(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a function of a task that hands the memory it has freed back to the system when it ends.

    Python workers are kept for later tasks, and an executor has more of them than cores; what each of them holds on to
    after its largest batch adds up from stage to stage.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return tidy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder: computed once, lineage cut."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FILE_ROWS = 1 << 40  # more than a file has
BROADCAST_FILES = 50_000  # paths of so many files, some 10 MB, are sent to every task at most


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """The rows with a long that is unique and the same whenever the files are read, however they are split.

    It is the file's number in the order of paths and the row's place in the file. What isn't read from files that tell
    these is stored first. The numbers are a written table of one row a file; none of it reaches the driver.
    """
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        docs = stored(docs, "numbered")
    place = docs.metadataColumn("_metadata")
    paths = docs.select(place["file_path"].alias("_file")).distinct()
    order = Window.orderBy("_file")  # one row a file
    files = stored(paths.select((F.row_number().over(order) - 1).cast("bigint").alias("_number"), "_file"), "files")
    rows = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    placed = docs.select(rows.alias("_own"), place["file_path"].alias("_path"), place["row_index"].alias("_place"))
    files = F.broadcast(files) if files.count() <= BROADCAST_FILES else files
    joined = placed.join(files, F.col("_path") == F.col("_file"))
    return joined.select(*(F.col(f"_own.`{c}`") for c in docs.columns), (F.col("_number") * FILE_ROWS + F.col("_place")).alias(name))


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def first_by_hash(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """At most ``rows`` rows, those that come first by a hash of the columns.

    Only rows below a hash that about four times as many lie under are sorted at all; else every task would send its
    own first ``rows`` to the driver, and that would grow with the number of tasks.
    """
    order = F.xxhash64(*columns)
    share = 4 * rows / max(df.count(), 1)
    some = df if share >= 1 else df.filter(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    return some.withColumn("_order", order).orderBy("_order").limit(rows).drop("_order")


def texts(column: pa.Array) -> pa.Array:
    """Null texts become empty ones."""
    return pc.fill_null(column, "")


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words (runs without the six ASCII white-space characters) of all texts, and where each text's words start.

    The first result has one entry more than there are texts.
    """
    parts = pc.ascii_split_whitespace(text)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))])
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    return before[bounds], flat.filter(full)


def word_ids(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the distinct words by number."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a batch of texts without nulls, and where each text starts (one entry more)."""
    if len(text) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = text.buffers()
    starts = np.frombuffer(offsets, np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return starts - starts[0], raw


def blank_parts(text: pa.Array) -> tuple[np.ndarray, pa.Array, list[str]]:
    """Each text cut at every blank: where its parts start (one entry more), the parts' numbers, the distinct parts."""
    parts = pc.split_pattern(text, " ")
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))])
    coded = parts.flatten().dictionary_encode()
    return bounds, coded.indices, coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def joined(values: list[bytes] | pa.Array, numbers: pa.Array, bounds: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The values at the given numbers in one buffer, and where each text's values start in it (one entry more)."""
    taken = (values if isinstance(values, pa.Array) else pa.array(values, pa.large_binary())).take(numbers)
    _, offsets, data = taken.buffers()
    starts = np.frombuffer(offsets, np.int64, len(taken) + 1, taken.offset * 8)
    return memoryview(data if data is not None else b""), starts[bounds]
