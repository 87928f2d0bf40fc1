"""Revenue marts that follow the change set: what changed picks the subscriptions, these the customers, these the months.

    root/lifecycle     classified events, by subscription; is_known tells whether the subscription has been loaded
    root/deltas        what each subscription changes in a month, by customer
    root/changes       the change rows of each customer with their movements, by customer
    root/flows         sums of the change rows per month: one row a month, written last, which commits the refresh

A refresh reads the classified events' keys, and else only the buckets of subscriptions and customers that changed. The
flows of these customers before and after give the difference that the months take. The first refresh, in which
everything is new, is the full build: it looks nothing up and writes each table once.

Rows that a refresh writes have a column ``is_moving``: those of the subscriptions or customers that it is about. It reads
them back by it, where a join would shuffle and sort both sides by ids again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.plans import marts, revenue
from subtally.session import shared_dir
from subtally.sources.buckets import BUCKETS, bucket_of, forget_after, manifest, read_buckets, replace_buckets
from subtally.sources.tables import drop_versions, read_current, versions, write_version

LIFECYCLE = (
    "event_id string, subscription_id string, customer_id string, event_type string, occurred_at timestamp, plan_key string, "
    "previous_plan_key string, mrr_before decimal(12,2), mrr_after decimal(12,2), is_known boolean"
)
DELTAS = "customer_id string, subscription_id string, month date, delta decimal(22,2)"
CHANGES = (
    "customer_id string, month date, mrr decimal(22,2), next_month date, is_first boolean, previous_mrr decimal(22,2), "
    "movement string, is_known boolean"
)
SUMS = ("n_changes", "change", "turned", *revenue.FLOWS)


@dataclass(frozen=True)
class Loaded:
    """What was loaded since the last refresh, and all ids that are known by now.

    ``events`` are the staged subscription events among the changed ones, ``event_ids`` (event_id) all changed ones.
    """

    events: DataFrame
    event_ids: DataFrame
    subscriptions: DataFrame  # subscription_id of what changed
    customers: DataFrame  # customer_id of what changed
    subscription_ids: DataFrame
    customer_ids: DataFrame


def written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "refresh")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_of(keys: DataFrame, key: str, n: int) -> list[int]:
    return [r[0] for r in keys.select(bucket_of(key, n)).distinct().collect()]  # one row a bucket


def dealt(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Rows with the bucket of their key, a task for each bucket: joins by bucket and key need no other shuffle."""
    return rows.withColumn("bucket", bucket_of(key, n)).repartition("bucket")


def looked_up(rows: DataFrame, marks: DataFrame, key: str, how: str = "left", null_safe: bool = False) -> DataFrame:
    """A join of dealt rows with marks that are dealt alike, without another shuffle.

    A task holds the marks of its buckets, which are narrow, in a hash table: no rows are sorted by ids that begin alike.
    """
    marks = marks.withColumnsRenamed({"bucket": "_bucket", key: "_key"}).hint("shuffle_hash")
    equal = rows[key].eqNullSafe(marks["_key"]) if null_safe else rows[key] == marks["_key"]
    return rows.join(marks, (rows["bucket"] == marks["_bucket"]) & equal, how).drop("_bucket", "_key")


def hashed(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Dealt rows with a hash of their key: sorted by it first, ids that begin alike are rarely compared."""
    return dealt(rows.withColumn("_hash", F.xxhash64(key)), key, n)


def columns_of(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.replace("(12,2)", "").replace("(22,2)", "").split(",")]


def replace(root: str, version: str, rows: DataFrame, schema: str, touched: list[int], n: int) -> None:
    """Writes dealt rows, of which those that this refresh is about are marked."""
    replace_buckets(root, version, rows.select(*columns_of(schema), "bucket", "is_moving"), touched, n)


def moved(spark: SparkSession, root: str, schema: str, touched: list[int]) -> DataFrame:
    """The marked rows of buckets that this refresh has just written; other readers don't ask for the mark."""
    return read_buckets(spark, root, f"{schema}, is_moving boolean", only=touched).filter("is_moving").drop("is_moving")


def refresh(spark: SparkSession, root: str, version: str, loaded: Loaded, plans: DataFrame, n: int = BUCKETS) -> list[int]:
    """Brings the tables up to date; returns the buckets of customers that were written.

    A refresh that failed has left no flows, and the next one starts from where the last complete one ended. Prices come
    from ``plans``: where these changed, events that didn't have other amounts, and only a build from nothing is right.
    """
    lifecycle, deltas, changes, flows = (f"{root}/{name}" for name in ("lifecycle", "deltas", "changes", "flows"))
    done = [v for v in versions(spark, flows) if v < version]
    for table in (lifecycle, deltas, changes):
        forget_after(spark, table, done[-1] if done else "")
    drop_versions(spark, flows, [v for v in versions(spark, flows) if v >= version])
    held = manifest(spark, lifecycle)
    n = len(held) or n
    is_moving = F.lit(True).alias("is_moving")

    # Events: those that came again replace what they were, and subscriptions that came now make older ones count. All are
    # dealt by the bucket of their subscription, once, and stay where they are up to the table.
    known = dealt(loaded.subscription_ids.selectExpr("subscription_id", "true AS is_known"), "subscription_id", n)
    fresh = looked_up(dealt(marts.classified(loaded.events, plans), "subscription_id", n), known, "subscription_id")
    fresh = fresh.withColumn("is_known", F.coalesce("is_known", F.lit(False)))
    if held:
        fresh = written(fresh)
        before = read_buckets(spark, lifecycle, LIFECYCLE).select("event_id", "subscription_id", "customer_id", "is_known")
        replaced = written(before.join(loaded.event_ids, "event_id", "left_semi"))
        own = fresh.select("subscription_id").unionByName(replaced.select("subscription_id")).withColumn("_came", F.lit(False))
        own = own.unionByName(loaded.subscriptions.selectExpr("subscription_id", "true AS _came"))
        subscriptions = written(own.groupBy("subscription_id").agg(F.max("_came").alias("_came")))
        touched = buckets_of(subscriptions, "subscription_id", n)
        old = dealt(read_buckets(spark, lifecycle, LIFECYCLE, only=touched), "subscription_id", n)
        again = dealt(replaced, "subscription_id", n).select("bucket", "event_id")
        kept = looked_up(old, again, "event_id", "left_anti")
        kept = looked_up(kept, dealt(subscriptions, "subscription_id", n), "subscription_id")
        kept = kept.withColumn("is_moving", F.col("_came").isNotNull())
        kept = kept.withColumn("is_known", F.col("is_known") | F.coalesce("_came", F.lit(False))).drop("_came")
        rows = kept.unionByName(fresh.select("*", is_moving))
    else:  # everything is new
        touched, rows = list(range(n)), fresh.select("*", is_moving)
    replace(lifecycle, version, rows, LIFECYCLE, touched, n)
    now = moved(spark, lifecycle, LIFECYCLE, touched).filter("is_known")
    own = revenue.subscription_deltas(hashed(now, "subscription_id", n), "_hash", "bucket").drop("_hash", "bucket")

    # Customers: of those subscriptions as they were and as they are, and those that came themselves. Where a row of theirs
    # wasn't replaced, it is still among those of now.
    if held:
        were = replaced.filter("is_known").select("customer_id")
        found = were.unionByName(now.select("customer_id")).unionByName(loaded.customers.select("customer_id"))
        customers = written(found.distinct())
        touched = buckets_of(customers, "customer_id", n)
        others = read_buckets(spark, deltas, DELTAS, only=touched).join(subscriptions, "subscription_id", "left_anti")
        marks = dealt(customers.select("customer_id", is_moving), "customer_id", n)

        def marked(rows: DataFrame) -> DataFrame:
            found = looked_up(rows, marks, "customer_id", null_safe=True)
            return found.withColumn("is_moving", F.coalesce("is_moving", F.lit(False)))

        rows = marked(dealt(others.unionByName(own), "customer_id", n))
    else:
        touched, rows = list(range(n)), dealt(own, "customer_id", n).select("*", is_moving)
    replace(deltas, version, rows, DELTAS, touched, n)

    # Their changes, within the bucket from the sums to the table. What they added to the months before goes from these.
    sums = revenue.summed(hashed(moved(spark, deltas, DELTAS, touched), "customer_id", n), "_hash", "bucket")
    known = dealt(loaded.customer_ids.selectExpr("customer_id", "true AS is_known"), "customer_id", n)
    rows = revenue.with_movement(looked_up(sums, known, "customer_id"), "_hash", "bucket").drop("_hash").select("*", is_moving)
    parts = None
    if held:
        was = marked(dealt(read_buckets(spark, changes, CHANGES, only=touched), "customer_id", n))
        parts = written(revenue.month_flows(was.filter("is_moving")).select("month", *[(-F.col(c)).alias(c) for c in SUMS]))
        rows = rows.unionByName(was.filter("NOT is_moving"))
    replace(changes, version, rows, CHANGES, touched, n)

    # Months: what these customers added before goes, what they add now comes.
    came = revenue.month_flows(moved(spark, changes, CHANGES, touched))
    parts = came if parts is None else came.unionByName(parts)
    last = read_current(spark, flows, before=version)
    parts = parts if last is None else last.unionByName(parts)
    types = {f.name: f.dataType for f in came.schema}
    total = parts.groupBy("month").agg(*[F.sum(c).cast(types[c]).alias(c) for c in SUMS]).filter("n_changes > 0")
    write_version(total.coalesce(1), flows, version)
    return touched


def last_refresh(spark: SparkSession, root: str) -> str | None:
    done = versions(spark, f"{root}/flows")
    return done[-1] if done else None


def lifecycle_events(spark: SparkSession, root: str) -> DataFrame:
    """fct_subscription_events from the refreshed tables."""
    return read_buckets(spark, f"{root}/lifecycle", LIFECYCLE).filter("is_known").select(*marts.LIFECYCLE)


def mrr_monthly(spark: SparkSession, root: str) -> DataFrame:
    return revenue.series(read_current(spark, f"{root}/flows"))


def mrr_customer_monthly(spark: SparkSession, root: str, customer_ids: DataFrame) -> DataFrame:
    """The dense table unfolded from the change rows, which hold each customer's months in order already."""
    rows = read_buckets(spark, f"{root}/changes", CHANGES).filter("is_known").drop("is_known")
    joined = customer_ids.select("customer_id").join(rows, "customer_id", "left")
    ends = read_current(spark, f"{root}/flows").selectExpr("struct(min(month) AS first_month, max(month) AS last_month)").scalar()
    return revenue.unfolded(joined.withColumn("is_first", F.coalesce("is_first", F.lit(True))), ends.alias("ends"))
