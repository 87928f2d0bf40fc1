"""Joins in time: instants with the intervals that cover them, and the state that was in force at an instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.operators.neighbours import TASK_ROWS, with_last_known

DAY = 86_400


def covering(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    closed: str = "left",
    bin_seconds: int = 30 * DAY,
    how: str = "left",
) -> DataFrame:
    """Points joined with the intervals of the same keys that cover them; an interval without an end stays open.

    Time is cut into bins. A point lies in one bin and an interval is put into every bin that it meets, so rows meet by
    equality of keys and bin and only then by time: what a key costs follows its points and intervals, not their product.
    Both sides are shuffled and merged: a size estimated before intervals are put into bins says nothing about the rows
    after it, and would have them all sent through the driver.
    ``closed`` says which end belongs to an interval: start <= at < end (left) or start < at <= end (right). Intervals are
    cut to the bins that hold points. NULL keys and times match nothing; a left join keeps such points. Other column names
    of the two sides have to differ.
    """

    def bin_of(time: str) -> str:
        seconds = f"unix_seconds(cast({time} AS timestamp))"
        return f"{seconds} DIV {bin_seconds} - int({seconds} % {bin_seconds} < 0)"

    if closed not in ("left", "right"):
        raise ValueError(f"closed must be left or right, not {closed}")
    placed = points.withColumn("_bin", F.expr(bin_of(at)))
    span = placed.agg(F.struct(F.min("_bin").alias("low"), F.max("_bin").alias("high"))).scalar()
    others = [c for c in intervals.columns if c not in keys]
    spread = (
        intervals.select(*(F.col(c).alias(f"_{c}") for c in keys), *others, span.alias("_span"))
        .withColumns({"_first": F.expr(f"greatest({bin_of(start)}, _span.low)"), "_last": F.expr(f"least(coalesce({bin_of(end)}, _span.high), _span.high)")})
        .filter("_first <= _last")
        .withColumn("_in", F.explode(F.sequence("_first", "_last")))
        .drop("_span", "_first", "_last")
    )
    low, high = ("<=", ">") if closed == "left" else ("<", ">=")
    inside = F.expr(f"{start} {low} {at} AND ({end} IS NULL OR {end} {high} {at})")
    same = F.expr(" AND ".join([*(f"{k} = _{k}" for k in keys), "_bin = _in"]))
    return placed.join(spread.hint("merge"), same & inside, how).drop("_bin", "_in", *(f"_{k}" for k in keys))


def state_as_of_many(
    history: DataFrame, asked: DataFrame, key: str, at: str = "at", task_rows: int = TASK_ROWS
) -> DataFrame:
    """Every asked (key, instant) row with the history row in force then, its columns NULL where there is none.

    Intervals of a key don't overlap, so the one that began last is the only candidate: both sides go into one order of
    time and carry the last beginning forward. A beginning at the instant counts, an end at it doesn't. A key that holds a
    large share of either side is cut into stretches of time. Repeated questions are answered each; a NULL key finds the
    history of NULL keys, a NULL instant nothing.
    """
    state = F.struct(*(F.col(c) for c in history.columns if c != key))
    began = history.filter("valid_from IS NOT NULL").select(F.col(key).alias("_key"), F.col("valid_from").alias("_time"), state.alias("_began"))
    question = F.struct(*asked.columns)
    asks = asked.select(F.col(key).alias("_key"), F.col(at).cast("timestamp").alias("_time"), question.alias("_asked"))
    # Of equal times the beginning comes first. Equal questions are interchangeable, but the order of rows must not be.
    both = began.withColumn("_asked", F.lit(None).cast(asks.schema["_asked"].dataType)).unionByName(
        asks.withColumn("_began", F.lit(None).cast(began.schema["_began"].dataType))
    )
    ordered = both.select("*", F.when(F.col("_asked").isNull(), 0).otherwise(1).alias("_rank"))
    known = with_last_known(ordered, "_key", ("_time", "_rank"), "_began", "_state", task_rows).filter("_asked IS NOT NULL")
    in_force = "_time IS NOT NULL AND (_state.valid_to IS NULL OR _state.valid_to > _time)"
    return known.select("_asked.*", F.expr(f"if({in_force}, _state, NULL)").alias("_state")).select(*asked.columns, "_state.*")
