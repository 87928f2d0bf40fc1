"""From landing rows and change events to raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.functions.documents import parse_once
from subtally.sources.landing import OBJECT_FOLDERS

# Fixed value: the event type that announces a deleted clock.
CLOCK_DELETED = "test_helpers.test_clock.deleted"

EVENT_SCHEMA = "struct<id:string,type:string,created:string,data:struct<object:string>>"
OBJECT_SCHEMA = "struct<object:string,id:string,test_clock:string>"


def latest_snapshot(raw: DataFrame, by: tuple[str, ...] = ("id",), order: tuple[str, ...] = ("file", "pos")) -> DataFrame:
    """Last document of each id, with the place it was found at. Partial aggregation leaves one row per id and task
    to shuffle, so an id that fills a third of the input costs no more than any other."""
    last = F.max_by(F.struct("data", *order), F.struct(*order)).alias("_last")
    return raw.groupBy(*by).agg(last).select(*by, "_last.*")


def upsert(target: DataFrame | None, batch: DataFrame, loaded_at: datetime | Column, deal: str | None = None) -> DataFrame:
    """Rows (id, data, loaded_at, file, pos): new ids in, ids absent from the batch kept: history, not a mirror.

    A known id is replaced unless the table has it from a later place in the landing: the order of files decides, not
    that of loads. The same place again replaces, so a repeated load restamps what is still landed. ``deal`` names a column
    of both that follows from the id; rows are dealt by it, once, and keep it. Without a target the batch, which has an id
    once, is the table already.
    """
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    key = [deal] if deal else []
    fresh = batch.select("id", "data", stamp.cast("timestamp").alias("loaded_at"), "file", "pos", *key)
    if target is None:
        return fresh.repartition(deal) if deal else fresh
    both = target.select(*fresh.columns, F.lit(0).alias("_new")).unionByName(fresh.withColumn("_new", F.lit(1)))
    newest = F.max_by(F.struct("data", "loaded_at", "file", "pos"), F.struct("file", "pos", "_new")).alias("_row")
    dealt = both.repartition(deal) if deal else both
    return dealt.groupBy(*key, "id").agg(newest).select("id", "_row.*", *key)


def parse_feed(feed: DataFrame, *keep: str) -> DataFrame:
    """Change-event documents (batch, source_pos, data, kept columns) with the fields that steer the load.

    ``snapshot`` is the JSON text of the changed object.
    """
    event = parse_once(feed, "data", EVENT_SCHEMA, "event")
    return parse_once(event.selectExpr("*", "event.data.object AS snapshot"), "snapshot", OBJECT_SCHEMA, "o").selectExpr(
        "batch",
        "source_pos",
        "event.id AS event_id",
        "event.type AS event_type",
        "cast(event.created AS bigint) AS created",
        "o.object AS object_kind",
        "o.id AS object_id",
        "o.test_clock AS test_clock",
        "snapshot",
        "data",
        *keep,
    )


def incremental_filter(events: DataFrame, since: int) -> DataFrame:
    """Events at or after the cursor; the overlap of one second is absorbed by the upsert.

    The feed lists newest first, so the chronological order key is (created, seq).
    """
    return events.filter(F.col("created") >= since).withColumn("seq", -F.col("source_pos"))


def next_cursor(events: DataFrame, since: int) -> DataFrame:
    """Newest event time among the survivors, or the old cursor when there are none."""
    return events.agg(F.coalesce(F.max("created"), F.lit(since).cast("bigint")).alias("cursor"))


def dead_clocks(events: DataFrame) -> DataFrame:
    """(batch, _clock) of the clocks that each sync reports as deleted."""
    deletions = events.filter(F.col("event_type") == CLOCK_DELETED)
    return deletions.select("batch", F.col("object_id").alias("_clock")).distinct()


def without_dead_clocks(rows: DataFrame, dead: DataFrame) -> DataFrame:
    """The rows (batch, test_clock, ...) whose clock was not deleted in the same sync."""
    # Most rows have no clock. If the join has to shuffle, a NULL key would put them all into one task; keys of
    # their own spread them and match nothing.
    clock = F.coalesce("test_clock", F.concat(F.lit("\0"), F.xxhash64("data").cast("string")))
    return rows.withColumn("_clock", clock).join(dead, ["batch", "_clock"], "left_anti").select(*rows.columns)


def drop_dead_clock_cascade(events: DataFrame) -> DataFrame:
    """Drop events of objects whose clock was deleted in the same sync batch.

    Deleting a clock cancels everything on it, which would look like real churn. Events without
    a clock, and the deletion itself, stay.
    """
    return without_dead_clocks(events, dead_clocks(events))


def folder_of_object() -> Column:
    """The raw table of the object inside an event, NULL for one that nobody loads."""
    pairs = [F.lit(x) for pair in OBJECT_FOLDERS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("object_kind"))


def route_snapshots(events: DataFrame, *keep: str) -> DataFrame:
    """The object inside each event, addressed to its raw table; previews have no id and drop out."""
    return (
        events.withColumn("type", folder_of_object())
        .filter(F.col("type").isNotNull() & F.col("object_id").isNotNull())
        .select("type", F.col("object_id").alias("id"), "batch", "created", "source_pos", F.col("snapshot").alias("data"), *keep)
    )


def sample_by_parent(raw: dict[str, DataFrame], k: int = 2) -> DataFrame:
    """Customers of the first k clocks and everything that belongs to them, as (type, id, data)."""
    clock = F.get_json_object("data", "$.test_clock")
    customers = raw["customers"].withColumn("_clock", clock)
    clocks = customers.select("_clock").filter(F.col("_clock").isNotNull()).distinct().orderBy("_clock").limit(k)
    kept = customers.join(F.broadcast(clocks), "_clock", "left_semi").select("id", "data")  # k rows
    parents = kept.select(F.col("id").alias("_parent"))

    def children(name: str, path: str) -> DataFrame:
        frame = raw[name]
        if name == "events":
            frame = frame.filter(F.get_json_object("data", "$.type").startswith("customer.subscription"))
        return (
            frame.withColumn("_parent", F.get_json_object("data", path))
            .join(parents, "_parent", "left_semi")
            .select(F.lit(name).alias("type"), "id", "data")
        )

    sample = kept.select(F.lit("customers").alias("type"), "id", "data")
    for name in ("subscriptions", "invoices", "charges"):
        sample = sample.unionByName(children(name, "$.customer"))
    return sample.unionByName(children("events", "$.data.object.customer"))
