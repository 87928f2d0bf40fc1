"""The load as a stream: new landing files in, one change set per micro-batch out.

The checkpoint is the cursor. Each micro-batch overwrites its own folders, so a replay after a crash leaves the same
files. A sync may have any number of files in any number of micro-batches: what a deleted clock takes along is decided
when the change sets are read, with all clocks of the sync known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.operators.ingest import CLOCK_DELETED, folder_of_object, latest_snapshot, parse_feed, without_dead_clocks
from subtally.sources.landing import explode_array_files, relative_file, sync_of
from subtally.sources.tables import children, matching

CHANGE_SCHEMA = "id string, batch string, test_clock string, file string, pos bigint, data string, batch_id bigint, type string"
CLOCK_SCHEMA = "batch string, _clock string, batch_id bigint"
# What a deleted clock is filed under in a change set; no object type is called so.
CLOCKS = "clocks"


def feed_from_files(files: DataFrame) -> DataFrame:
    """(file, value = JSON array of change events, oldest first) to feed rows; ``batch`` is the sync they came with."""
    rows = explode_array_files(files)
    return rows.select(sync_of().alias("batch"), "file", (-F.col("pos")).alias("source_pos"), "data")


def changed_objects(feed: DataFrame) -> DataFrame:
    """(type, id, batch, test_clock, file, pos, data): the last snapshot of each object for each sync and clock, the
    events themselves, and as ``CLOCKS`` the clocks that were deleted. Clocks are told apart, so that dropping a dead one
    uncovers the snapshot before it. An event unfolds into all its rows at once, so files are read and parsed once."""
    row = "struct<type:string,id:string,data:string>"
    event = F.struct(F.lit("events").alias("type"), F.col("event_id").alias("id"), "data").cast(row)
    inside = F.struct(folder_of_object().alias("type"), F.col("object_id").alias("id"), F.col("snapshot").alias("data")).cast(row)
    clock = F.struct(F.lit(CLOCKS).alias("type"), F.col("object_id").alias("id"), F.lit(None).alias("data")).cast(row)
    rows = F.array(
        event,
        F.when(inside["type"].isNotNull() & inside["id"].isNotNull(), inside),
        F.when(F.col("event_type") == CLOCK_DELETED, clock),
    )
    columns = ["batch", "test_clock", "file", (-F.col("source_pos")).alias("pos")]
    everything = feed.select(*columns, F.inline(F.array_compact(rows)))
    return latest_snapshot(everything, by=("type", "id", "batch", "test_clock"))


def stream_load(spark: SparkSession, landing: str, changes: str, checkpoint: str, max_files: int = 1000) -> None:
    """Process all landing files that arrived since the last call, then stop."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select(relative_file(landing).alias("file"), "value")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        feed = parse_feed(feed_from_files(batch), "file")
        changed_objects(feed).write.mode("overwrite").partitionBy("type").parquet(f"{changes}/objects/batch_id={batch_id}")

    query = (
        files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def change_sets(spark: SparkSession, changes: str) -> tuple[DataFrame, DataFrame]:
    """The objects of all change sets, and (batch, _clock, batch_id) of the clocks that were deleted with them.

    Change sets that older code wrote have their clocks in a folder beside.
    """
    root = f"{changes}/objects"
    reader = spark.read.schema(CHANGE_SCHEMA)
    # Read by their own folders, so that what they are joined with is planned for their size.
    own = matching(spark, f"{root}/batch_id=*/type={CLOCKS}")
    rows = reader.option("basePath", root).parquet(*own) if own else spark.createDataFrame([], CHANGE_SCHEMA)
    clocks = rows.select("batch", F.col("id").alias("_clock"), "batch_id")
    if children(spark, f"{changes}/clocks"):
        clocks = clocks.unionByName(spark.read.schema(CLOCK_SCHEMA).parquet(f"{changes}/clocks"))
    return spark.read.schema(CHANGE_SCHEMA).parquet(root).filter(F.col("type") != CLOCKS), clocks


def read_changes(spark: SparkSession, changes: str, after: int = -1) -> DataFrame:
    """(type, id, file, pos, data): the current document of every object in the change sets after a micro-batch.

    Newest file, then position, as in the batch load: arrival order does not count, so a file that shows up late cannot
    undo a newer one. Clocks are read from all change sets.
    """
    objects, clocks = change_sets(spark, changes)
    dead = clocks.select("batch", "_clock").distinct()
    return latest_snapshot(without_dead_clocks(objects.filter(F.col("batch_id") > after), dead), by=("type", "id"))


def taken_back(spark: SparkSession, changes: str, after: int) -> tuple[DataFrame, DataFrame]:
    """What clocks that were reported deleted after a micro-batch undo of the change sets up to it.

    (type, id, file, pos) of the rows that no longer count, and as ``read_changes`` the documents that their objects have
    without them. Only change sets that came with such a clock's sync are looked at again in full.
    """
    objects, clocks = change_sets(spark, changes)
    late = clocks.filter(F.col("batch_id") > after).select("batch", F.col("_clock").alias("test_clock")).distinct()
    folded = objects.filter(F.col("batch_id") <= after)
    dead = folded.join(late, ["batch", "test_clock"], "left_semi").select("type", "id", "file", "pos").distinct()
    theirs = objects.join(dead.select("type", "id").distinct(), ["type", "id"], "left_semi")
    left = without_dead_clocks(theirs, clocks.select("batch", "_clock").distinct())
    return dead, latest_snapshot(left, by=("type", "id"))


def newest_batch(spark: SparkSession, changes: str) -> int:
    """Number of the newest change set, -1 without one."""
    last = spark.read.schema(CHANGE_SCHEMA).parquet(f"{changes}/objects").agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last
