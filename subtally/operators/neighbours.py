"""Previous and next row of a key, also when one key holds a large share of all rows.

A window over a key puts the key's rows into one task. Keys with more rows than a task should hold are counted, cut into
stretches of their order by a range partitioning, and stitched together at the edges; all others take a plain window.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtally.session import shared_dir

# Rows of one key that a single task sorts; a key with more is cut into stretches of about as many.
TASK_ROWS = 5_000_000


def _written(df: DataFrame) -> DataFrame:
    path = f"{shared_dir(df.sparkSession, 'neighbours')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def large_keys(df: DataFrame, key: str, task_rows: int) -> DataFrame:
    """(_key, _n) of the keys, NULL among them, with more rows than ``task_rows``; counts are formed before the shuffle."""
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    return counts.filter(F.col("_n") > task_rows)


def stretches(hot: DataFrame, key: str, by_order: list[Column], rows: int, task_rows: int) -> DataFrame:
    """The rows of large keys with ``_piece``, a number that rises with the order: every task holds one piece.

    Where the pieces end is estimated, so which one a row is in is written down before anything builds on it.
    """
    dealt = hot.repartitionByRange(-(-rows // task_rows), F.col(key).asc_nulls_last(), *by_order)
    return _written(dealt.withColumn("_piece", F.spark_partition_id()))


def split_by_size(df: DataFrame, key: str, task_rows: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of ordinary keys, rows of large keys or None, how many those are).

    Keys are counted first, which reads the key alone; only where there is a large one is the input written down, once.
    """
    large = large_keys(df, key, task_rows)
    total = large.agg(F.sum("_n")).first()[0]
    if total is None:
        return df, None, 0
    rows, large = _written(df), _written(large)
    is_large = F.col(key).eqNullSafe(F.col("_key_of_large"))
    large = large.withColumnRenamed("_key", "_key_of_large")
    return rows.join(large, is_large, "left_anti"), rows.join(large, is_large, "left_semi"), total


def with_neighbours(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    carry: Sequence[str],
    previous: str | None = None,
    following: str | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the carried columns of the neighbouring rows as struct columns (NULL at the ends).

    ``order`` must identify a row within its key, so the neighbours are well defined; NULLs come last. A NULL key is a
    key.
    """
    carried = F.struct(*carry)
    by_order = [F.col(c).asc_nulls_last() for c in order]

    def add(frame: DataFrame, *partition: str) -> DataFrame:
        w = Window.partitionBy(*partition).orderBy(*by_order)
        if previous:
            frame = frame.withColumn(previous, F.lag(carried).over(w))
        if following:
            frame = frame.withColumn(following, F.lead(carried).over(w))
        return frame

    ordinary, hot, total = split_by_size(df, key, task_rows)
    ordinary = add(ordinary, key)
    if hot is None:
        return ordinary
    cut = stretches(hot, key, by_order, total, task_rows)
    at = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))])
    by_piece = Window.partitionBy("_edge_key").orderBy("_edge_piece")  # a row for each stretch
    edges = (
        cut.groupBy(F.col(key).alias("_edge_key"), F.col("_piece").alias("_edge_piece"))
        .agg(F.min_by(carried, at).alias("_first"), F.max_by(carried, at).alias("_last"))
        .select(
            "_edge_key",
            "_edge_piece",
            F.lag("_last").over(by_piece).alias("_before"),
            F.lead("_first").over(by_piece).alias("_after"),
        )
    )
    stitched = stitch(add(dealt(cut, key), key, "_piece"), edges, key)
    if previous:
        stitched = stitched.withColumn(previous, F.coalesce(previous, "_before"))
    if following:
        stitched = stitched.withColumn(following, F.coalesce(following, "_after"))
    return ordinary.unionByName(stitched.select(*ordinary.columns))


def dealt(cut: DataFrame, key: str) -> DataFrame:
    """By both columns: an exchange on the key alone would also satisfy the window and gather the whole key again."""
    return cut.repartition(F.col(key), F.col("_piece"))


def stitch(inner: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    return inner.join(edges, F.col(key).eqNullSafe(F.col("_edge_key")) & (F.col("_piece") == F.col("_edge_piece")))


def with_last_known(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add the last value of the key that isn't NULL, at or before each row in the order; NULLs of the order come last.

    Rows that are equal in the whole order may only differ in values if at most one of those isn't NULL.
    """
    by_order = [*(F.col(c).asc_nulls_last() for c in order), F.col(value).isNull().asc()]

    def add(frame: DataFrame, *partition: str) -> DataFrame:
        sofar = Window.partitionBy(*partition).orderBy(*by_order).rowsBetween(Window.unboundedPreceding, 0)
        return frame.withColumn(name, F.last(value, ignorenulls=True).over(sofar))

    ordinary, hot, total = split_by_size(df, key, task_rows)
    ordinary = add(ordinary, key)
    if hot is None:
        return ordinary
    cut = stretches(hot, key, by_order, total, task_rows)
    at = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))])
    last = F.expr(f"max_by({value}, _at) FILTER (WHERE {value} IS NOT NULL)")
    by_piece = Window.partitionBy("_edge_key").orderBy("_edge_piece")
    edges = (
        cut.withColumn("_at", at)
        .groupBy(F.col(key).alias("_edge_key"), F.col("_piece").alias("_edge_piece"))
        .agg(last.alias("_last"))
        .select(
            "_edge_key",
            "_edge_piece",
            F.last("_last", ignorenulls=True).over(by_piece.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        )
    )
    stitched = stitch(add(dealt(cut, key), key, "_piece"), edges, key).withColumn(name, F.coalesce(name, "_before"))
    return ordinary.unionByName(stitched.select(*ordinary.columns))
