"""Type-2 history: one row per key and interval of constant state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subtally.sources.tables import drop_versions, versions


def scd2_step(
    open_rows: DataFrame, batch: DataFrame, key: str, check: Sequence[str], at: datetime | Column
) -> DataFrame:
    """One snapshot run over the open rows: unchanged ones stay, changed ones close and reopen.

    A key missing from the batch stays open. Both sides hold a key once, so one full join and no
    window do it. ``batch`` has the columns of ``open_rows`` without the validity interval.
    """
    run = (at if isinstance(at, Column) else F.lit(at)).cast("timestamp")
    columns = [c for c in open_rows.columns if c not in ("valid_from", "valid_to")]
    old = open_rows.select(F.col(key).alias("_k"), F.struct(*open_rows.columns).alias("_old"))
    new = batch.select(F.col(key).alias("_k"), F.struct(*columns).alias("_new"))

    def state(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in check])

    unchanged = F.col("_new").isNull() | (F.col("_old").isNotNull() & state("_old").eqNullSafe(state("_new")))

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns], start.alias("valid_from"), end.alias("valid_to")
        )

    no_end = F.lit(None).cast("timestamp")
    keep_or_close = F.when(
        F.col("_old").isNotNull(), row("_old", F.col("_old.valid_from"), F.when(~unchanged, run))
    )
    reopen = F.when(~unchanged, row("_new", run, no_end))
    joined = old.join(new, "_k", "full")
    return joined.select(F.inline(F.filter(F.array(keep_or_close, reopen), lambda r: r.isNotNull())))


def scd2_apply(
    history: DataFrame, batch: DataFrame, key: str, check: Sequence[str], at: datetime | Column
) -> DataFrame:
    """A whole history advanced by one run; closed rows pass through without a shuffle."""
    closed = history.filter(F.col("valid_to").isNotNull())
    open_rows = history.filter(F.col("valid_to").isNull())
    return closed.unionByName(scd2_step(open_rows, batch, key, check, at))


def snapshot_run(
    spark: SparkSession, root: str, batch: DataFrame, key: str, check: Sequence[str], at: datetime
) -> None:
    """Advance the stored history by one run.

    Each run writes the full open set and only the rows it closed, split by ``is_current``.
    Repeating a run overwrites its own folder from the state before it. Open sets older than that one go.
    """
    label = at.strftime("%Y-%m-%dT%H-%M-%SZ")
    earlier = [v for v in versions(spark, root, label="run") if v < label]
    schema = StructType(list(batch.schema.fields)).add("valid_from", "timestamp").add("valid_to", "timestamp")
    if earlier:
        stored = spark.read.schema(schema.add("is_current", "boolean")).parquet(f"{root}/run={earlier[-1]}")
        open_rows = stored.filter("is_current").drop("is_current")
    else:
        open_rows = spark.createDataFrame([], schema)
    step = scd2_step(open_rows, batch, key, check, at)
    (
        step.withColumn("is_current", F.col("valid_to").isNull())
        .write.mode("overwrite")
        .partitionBy("is_current")
        .parquet(f"{root}/run={label}")
    )
    for run in earlier[:-1]:
        drop_versions(spark, f"{root}/run={run}", ["true"], label="is_current")


def read_history(spark: SparkSession, root: str, schema: str | StructType | None = None) -> DataFrame:
    """Rows closed by any complete run and the open set of the newest one (partition pruned).

    Before the first run there are no rows; ``schema`` says what they would look like.
    """
    runs = versions(spark, root, label="run")
    if not runs:
        if schema is None:
            raise ValueError(f"no snapshot run under {root} and no schema given")
        return spark.createDataFrame([], schema)
    paths = [f"{root}/run={r}" for r in runs]
    frame = spark.read.option("basePath", root).parquet(*paths)
    newest = F.col("run").cast("string") == runs[-1]
    return frame.filter(~F.col("is_current").cast("boolean") | newest).drop("run", "is_current")


def scd2_rebuild(batches: DataFrame, key: str, check: Sequence[str], run: str) -> DataFrame:
    """The history a fold over all runs would leave, in one pass.

    ``batches`` has one row per key and run, so a window holds at most as many rows as there were
    runs. Both windows share one exchange on the key.
    """
    w = Window.partitionBy(key).orderBy(run)
    columns = [c for c in batches.columns if c != run]
    state = F.struct(*check)
    return (
        batches.withColumn("_state", state)
        .withColumn("_before", F.lag("_state").over(w))
        .filter(~F.col("_state").eqNullSafe(F.col("_before")))
        .select(*columns, F.col(run).alias("valid_from"), F.lead(run).over(w).alias("valid_to"))
    )


def state_as_of(history: DataFrame, at: datetime | Column) -> DataFrame:
    """The rows that were valid at an instant."""
    instant = (at if isinstance(at, Column) else F.lit(at)).cast("timestamp")
    return history.filter(
        (F.col("valid_from") <= instant) & (F.col("valid_to").isNull() | (F.col("valid_to") > instant))
    )
