"""Type-2 history as a stream: every micro-batch of snapshots closes and opens the rows of its own keys.

    root/open                     the open row of each key, in buckets of the key
    root/closed/batch=<label>     what a batch closed; written once and never touched again

The stream's checkpoint says which batch comes next. A batch that is replayed after a crash starts from the open rows
before it and overwrites what it closed, so it leaves the same history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from subtally.session import shared_dir
from subtally.sources.buckets import BUCKETS, bucket_of, manifest, read_buckets, replace_buckets, staged
from subtally.sources.tables import versions


def open_schema(snapshots: StructType, run: str) -> StructType:
    return StructType([f for f in snapshots.fields if f.name != run]).add("valid_from", TimestampType())


def apply_snapshots(
    spark: SparkSession, root: str, snapshots: DataFrame, key: str, check: Sequence[str], run: str, label: str, n: int = BUCKETS
) -> None:
    """Brings snapshots (key, columns, run) of any number of runs into the history; only their keys' buckets are written.

    A key has one row in a run, and a batch none older than the key's open row: that raises. Labels of batches sort.
    """
    schema = open_schema(snapshots.schema, run)
    columns = [f.name for f in schema.fields if f.name != "valid_from"]
    n = len(manifest(spark, f"{root}/open", before=label)) or n
    fresh, touched = staged(snapshots, key, n)
    old = read_buckets(spark, f"{root}/open", schema, before=label, only=touched).withColumn("bucket", bucket_of(key, n))
    both = (
        old.withColumn("_new", F.lit(0))
        .unionByName(fresh.withColumnRenamed(run, "valid_from").withColumn("_new", F.lit(1)))
        .repartition("bucket")
        .withColumn("_state", F.struct(*check))
    )
    by_time = Window.partitionBy("bucket", key).orderBy("valid_from", "_new")
    late = (F.lag("_new").over(by_time) == 1) & (F.col("_new") == 0)
    steps = (
        both.withColumns({"_before": F.lag("_state").over(by_time), "_late": late})
        .filter(~F.col("_state").eqNullSafe(F.col("_before")) | F.coalesce("_late", F.lit(False)))
        .withColumn("valid_from", F.expr("if(_late, raise_error('a snapshot is older than the open row of its key'), valid_from)"))
        .withColumn("valid_to", F.lead("valid_from").over(by_time))
        .select(*columns, "valid_from", "valid_to", "bucket")
    )
    path = shared_dir(spark, "history-steps")
    steps.write.parquet(path)
    steps = spark.read.schema(steps.schema).parquet(path)
    steps.filter("valid_to IS NOT NULL").drop("bucket").write.mode("overwrite").parquet(f"{root}/closed/batch={label}")
    still_open = steps.filter("valid_to IS NULL").drop("valid_to").repartition("bucket")
    replace_buckets(f"{root}/open", label, still_open, touched, n)


def stream_history(
    spark: SparkSession, landing: str, schema: StructType, root: str, checkpoint: str, key: str, check: Sequence[str], run: str = "run"
) -> None:
    """Process all snapshot files (Parquet) that arrived since the last call, then stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_snapshots(spark, root, batch, key, check, run, f"{batch_id:012d}")

    files = spark.readStream.schema(schema).parquet(landing)
    query = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_stream_history(spark: SparkSession, root: str, snapshots: StructType, run: str = "run") -> DataFrame:
    """All rows (columns, valid_from, valid_to), closed ones of batches that the open rows know."""
    schema = open_schema(snapshots, run)
    rows = read_buckets(spark, f"{root}/open", schema).withColumn("valid_to", F.lit(None).cast("timestamp"))
    done = versions(spark, f"{root}/open/manifest")
    closed = [v for v in versions(spark, f"{root}/closed", label="batch") if done and v <= done[-1]]
    if not closed:
        return rows
    paths = [f"{root}/closed/batch={v}" for v in closed]
    return rows.unionByName(spark.read.schema(StructType([*schema.fields]).add("valid_to", TimestampType())).parquet(*paths))
