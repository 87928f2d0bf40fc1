"""The batch job: sync | load | stream | build | check | export | analyze | as-of.

    spark-submit submit.py sync   --feed F --landing L --warehouse W    change events to landing files (--full: all)
    spark-submit submit.py load   --landing L --warehouse W             new landing files to raw tables (--full: all)
    spark-submit submit.py stream --landing F --warehouse W             sync and load in one, as a stream
    spark-submit submit.py build  --warehouse W                         snapshot and marts
    spark-submit submit.py check  --warehouse W                         data tests, exit code 1 on failure;
        --customers --months --mrr --active LOW:HIGH                    bounds that depend on the business
    spark-submit submit.py export --warehouse W --out O                 dashboard document
    spark-submit submit.py analyze --warehouse W --out O                every analysis as a table
    spark-submit submit.py as-of  --warehouse W --out O --at T          subscriptions as they were

Every step is idempotent: it writes a new version, or overwrites its own output.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from subtally.operators.history import read_history, snapshot_run, state_as_of
from subtally.operators.ingest import (
    drop_dead_clock_cascade,
    incremental_filter,
    latest_snapshot,
    next_cursor,
    parse_feed,
    route_snapshots,
    upsert,
)
from subtally.operators.quality import check, dashboard_check, declared_rules, freshness
from subtally.plans import analyses, dashboard, marts, refresh
from subtally.plans.staging import id_columns, ids, staging_views, stg_subscription_events
from subtally.session import build_session
from subtally.sources.buckets import manifest, read_buckets, update_buckets
from subtally.sources.landing import (
    LINES,
    OBJECT_TYPES,
    array_elements,
    entries,
    files_of,
    folder_stamp,
    in_utc,
    scan,
    write_landing,
)
from subtally.sources.state import load_state, save_state
from subtally.sources.tables import (
    changed_at,
    children,
    drop_versions,
    load_marts,
    object_folders,
    plain_path,
    publish_views,
    read_current,
    save_mart,
    versions,
    write_version,
)
from subtally.streaming.load import newest_batch, read_changes, stream_load, taken_back

# Marts that a build writes in full; those of revenue follow the change set, see plans/refresh.py.
MARTS = ["dim_plan", "dim_customer", "fct_invoices", "dim_subscription_history"]


# Sizes that depend on the business; the check step takes bounds for them.
BOUNDS = ("customers", "months", "mrr", "active")


def sync_feed(
    spark: SparkSession, feed: DataFrame, landing: str, state: str, at: datetime, full: bool = False
) -> int:
    """One incremental sync of a change feed (source_pos, data), newest event first.

    Keeps events since the stored cursor, drops the cascades of deleted clocks, lands the events and
    the object each one carries, and stores the new cursor last. Without a cursor everything is read
    and the cursor becomes the start time; so it is with ``full``, whatever was stored. Returns the cursor.
    """
    stamp = folder_stamp(at)
    known = {} if full else load_state(spark, state)
    since = known.get("cursor", 0)
    events = incremental_filter(parse_feed(feed.withColumn("batch", F.lit(stamp))), since)
    kept = drop_dead_clock_cascade(events).persist()  # read once per object type
    try:
        objects = route_snapshots(kept).selectExpr("type", "-source_pos AS pos", "data")
        landed = objects.unionByName(kept.selectExpr("'events' AS type", "seq AS pos", "data"))
        for name in sorted(r.type for r in landed.select("type").distinct().collect()):  # five at most
            write_landing(landed.filter(F.col("type") == name), landing, name, stamp)
        cursor = next_cursor(kept, since).first()["cursor"] if known else int(in_utc(at).timestamp())
    finally:
        kept.unpersist()
    save_state(spark, state, cursor, stamp)
    return cursor


RAW = "id string, data string, loaded_at timestamp, file string, pos bigint"
LOADED = "entry string, changed bigint"


def merge_raw(spark: SparkSession, root: str, version: str, batch: DataFrame, at: datetime, gone: DataFrame | None = None) -> None:
    """Upserts a batch, which has an id once, into a raw table; only the buckets of its ids are read and written.

    ``gone`` (id, file, pos) are rows that the table may have and that no longer count.
    """
    own = batch.select("id", "data", "file", "pos", F.lit(False).alias("gone"))
    if gone is not None:
        own = own.unionByName(gone.select("id", F.lit(None).cast("string").alias("data"), "file", "pos", F.lit(True).alias("gone")))

    is_new = not manifest(spark, root, before=version)  # then the batch is the table, with no rows to compare

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        kept = old if gone is None else old.join(new.filter("gone").select("id", "file", "pos"), ["id", "file", "pos"], "left_anti")
        return upsert(None if is_new else kept, new.filter("NOT gone"), F.lit(at).cast("timestamp"), deal="bucket")

    update_buckets(spark, root, version, own, "id", RAW, merge)


def unseen(spark: SparkSession, folder: str, seen: DataFrame | None) -> tuple[list[str], DataFrame]:
    """Entries of a landing folder that no load has read, or that changed since, and the list of all that are read then.

    A sync is recognised by its name and by when it last changed, so files inside old syncs needn't be listed.
    """
    root, changed = plain_path(spark, folder), changed_at(spark, folder)
    known = {} if seen is None else {r["entry"]: r["changed"] for r in seen.collect()}  # a row per sync
    now = {f"{root}/{name}": changed[name] for name in entries(spark, folder)}
    fresh = [e.rsplit("/", 1)[1] for e, at in now.items() if known.get(e) != at]
    return fresh, spark.createDataFrame(sorted({**known, **now}.items()), LOADED)


def load_entries(spark: SparkSession, root: str, version: str, folder: str, names: list[str] | None, at: datetime) -> None:
    """Merges entries of a landing folder into a raw table; an array file without an end raises, and is read again next time."""
    ended = Observation()
    lines = any(name.startswith(LINES) for name in (entries(spark, folder) if names is None else names))
    merge_raw(spark, root, version, latest_snapshot(scan(spark, folder, names, ended)), at)
    if not lines and ended.get["files"] < files_of(spark, folder, names):
        raise ValueError(f"MALFORMED_RECORD: an array file under {folder} has no end")


def load_all(spark: SparkSession, landing: str, warehouse: str, at: datetime, only_new: bool = False) -> DataFrame:
    """Upsert every object folder into its raw table; report (type, upserted, n_rows) from what was written.

    ``only_new`` reads the syncs that no such load has read before: what a load costs then follows what arrived. Files
    that come late win or lose by their names, as in a load of everything. Which syncs were read is stored last, so a
    crash makes the next load read them again, which is harmless.
    """
    reports = []
    version = folder_stamp(at)
    for name in object_folders(spark, landing):
        root, folder, log = f"{warehouse}/raw/{name}", f"{landing}/{name}", f"{warehouse}/loads/{name}"
        names, read = unseen(spark, folder, read_current(spark, log, before=version))
        if not only_new:
            names = None
        if names is None or names:
            load_entries(spark, root, version, folder, names, at)
        write_version(read.coalesce(1), log, version)
        table = read_buckets(spark, root, RAW)
        reports.append(
            table.agg(
                F.count_if(F.col("loaded_at") == F.lit(at)).alias("upserted"), F.count("*").alias("n_rows")
            ).select(F.lit(name).alias("type"), "upserted", "n_rows")
        )
    return reduce(DataFrame.unionByName, reports)


def fold_stream(spark: SparkSession, warehouse: str, at: datetime) -> None:
    """Bring the change sets since the last fold into the raw tables, in one new version of each.

    Rows that the tables have from later files stay, and only folded rows are restamped. A clock that was deleted since
    takes back what earlier folds had of its sync: the objects fall back on what the change sets have without it, or go.
    """
    changes, folds = f"{warehouse}/changes", f"{warehouse}/folds"
    after, newest = load_state(spark, folds).get("cursor", -1), newest_batch(spark, changes)
    if newest <= after:
        return
    current = read_changes(spark, changes, after)
    dead, left = taken_back(spark, changes, after)
    version = folder_stamp(at)
    for name in OBJECT_TYPES:
        fresh, again, gone = (rows.filter(F.col("type") == name) for rows in (current, left, dead))  # partition pruned
        both = latest_snapshot(fresh.select("id", "file", "pos", "data").unionByName(again.select("id", "file", "pos", "data")))
        merge_raw(spark, f"{warehouse}/raw/{name}", version, both, at, gone)
    save_state(spark, folds, newest, version)


def raw_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {name: read_buckets(spark, f"{warehouse}/raw/{name}", RAW) for name in OBJECT_TYPES}


def loaded_since(spark: SparkSession, root: str, since: str | None) -> DataFrame:
    """The rows of a raw table that a load has written at or after a version; only buckets written since are read."""
    if since is None:
        return read_buckets(spark, root, RAW)
    wanted = [b for b, v in manifest(spark, root).items() if v is not None and v >= since]
    return read_buckets(spark, root, RAW, only=wanted).filter(F.col("loaded_at") >= F.to_timestamp(F.lit(since), "yyyy-MM-dd'T'HH-mm-ss'Z'"))


def revenue_root(warehouse: str, plans: DataFrame) -> str:
    """Where the revenue tables for a price list are: other prices make other amounts of events that didn't change."""
    mark = plans.agg(F.concat_ws("-", F.count("*"), F.hex(F.expr(f"bit_xor(xxhash64({', '.join(sorted(plans.columns))}))")))).first()[0]
    return f"{warehouse}/revenue/prices-{mark}"


def refresh_revenue(spark: SparkSession, warehouse: str, version: str, plans: DataFrame) -> str:
    """Brings the revenue tables up to date with what was loaded since; returns where they are.

    With another price list than before everything is new, and the tables of the old one go afterwards.
    """
    root, raw = revenue_root(warehouse, plans), f"{warehouse}/raw"
    since = max((v for v in versions(spark, f"{root}/flows") if v < version), default=None)
    changed = {name: loaded_since(spark, f"{raw}/{name}", since) for name in ("events", "subscriptions", "customers")}
    tables = raw_tables(spark, warehouse)
    loaded = refresh.Loaded(
        events=stg_subscription_events(changed["events"]),
        event_ids=ids(changed["events"], "event_id"),
        subscriptions=ids(changed["subscriptions"], "subscription_id"),
        customers=ids(changed["customers"], "customer_id"),
        subscription_ids=ids(tables["subscriptions"], "subscription_id"),
        customer_ids=ids(tables["customers"], "customer_id"),
    )
    refresh.refresh(spark, root, version, loaded, plans)
    name = root.rsplit("/", 1)[1]
    drop_versions(spark, f"{warehouse}/revenue", [n.removeprefix("prices-") for n in children(spark, f"{warehouse}/revenue") if n != name], label="prices", joint="-")
    return root


def revenue_marts(spark: SparkSession, warehouse: str, plans: DataFrame) -> dict[str, DataFrame]:
    root = revenue_root(warehouse, plans)
    if refresh.last_refresh(spark, root) is None:
        raise ValueError(f"never built under {root}: fct_subscription_events, mrr_customer_monthly, mrr_monthly")
    customers = ids(raw_tables(spark, warehouse)["customers"], "customer_id")
    return {
        "fct_subscription_events": refresh.lifecycle_events(spark, root),
        "mrr_customer_monthly": refresh.mrr_customer_monthly(spark, root, customers),
        "mrr_monthly": refresh.mrr_monthly(spark, root),
    }


def all_marts(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    stored = load_marts(spark, f"{warehouse}/marts", MARTS)
    return {**stored, **revenue_marts(spark, warehouse, stored["dim_plan"])}


def build(spark: SparkSession, warehouse: str, at: datetime) -> dict[str, DataFrame]:
    """Staging views, one snapshot run, and the marts in dependency order, each read back from Parquet."""
    staging = staging_views(raw_tables(spark, warehouse))
    publish_views(staging)
    out, version = f"{warehouse}/marts", folder_stamp(at)

    def save(name: str, frame: DataFrame) -> DataFrame:
        return save_mart(frame, out, name, version)

    plans = save("dim_plan", marts.dim_plan(staging["stg_subscriptions"]))
    history = f"{warehouse}/snapshots/subscriptions"
    snapshot_run(spark, history, staging["stg_subscriptions"], "subscription_id", marts.SNAPSHOT_CHECK, at)
    refresh_revenue(spark, warehouse, version, plans)
    invoices = save("fct_invoices", marts.fct_invoices(staging["stg_invoices"], plans))
    built = {
        "dim_plan": plans,
        "fct_invoices": invoices,
        "dim_customer": save(
            "dim_customer", marts.dim_customer(staging["stg_customers"], staging["stg_subscriptions"], invoices)
        ),
        "dim_subscription_history": save(
            "dim_subscription_history", marts.dim_subscription_history(read_history(spark, history), plans)
        ),
    }
    return {**staging, **built, **revenue_marts(spark, warehouse, plans)}


def everything(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {**staging_views(raw_tables(spark, warehouse)), **all_marts(spark, warehouse)}


def check_all(spark: SparkSession, warehouse: str, **bounds) -> DataFrame:
    return check(everything(spark, warehouse), declared_rules(**bounds), id_columns(raw_tables(spark, warehouse)))


def export(spark: SparkSession, warehouse: str, at: datetime) -> DataFrame:
    tables = all_marts(spark, warehouse)
    retention = dashboard.cohort_retention(tables["dim_customer"], tables["fct_subscription_events"])
    return dashboard.dashboard_payload(
        at.isoformat(timespec="seconds"),
        dashboard.export_mrr_series(tables["mrr_monthly"]),
        dashboard.export_plans(tables["dim_customer"]),
        dashboard.export_cohorts(retention),
        dashboard.export_unpaid(tables["fct_invoices"]),
    )


def analyze(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Every analysis and dashboard table, by name, from the stored marts."""
    t = all_marts(spark, warehouse)
    charges = staging_views(raw_tables(spark, warehouse))["stg_charges"]
    customers, events, invoices, months = t["dim_customer"], t["fct_subscription_events"], t["fct_invoices"], t["mrr_monthly"]
    retention = dashboard.cohort_retention(customers, events)
    paying = analyses.customer_months_by_plan(customers, events)
    lost = analyses.cancellations_by_plan(events)
    return {
        "waterfall_long": analyses.waterfall_long(months),
        "monthly_churn_rate": analyses.monthly_churn_rate(months),
        "plan_status_crosstab": analyses.plan_status_crosstab(customers),
        "plan_reason_crosstab": analyses.plan_reason_crosstab(customers),
        "cohort_pivot": analyses.cohort_pivot(retention),
        "customer_months_by_plan": paying,
        "cancellations_by_plan": lost,
        "ltv_by_plan": analyses.ltv_by_plan(t["dim_plan"], paying, lost, customers),
        "charges_by_status": analyses.charges_by_status(charges),
        "unpaid_summary": analyses.unpaid_summary(invoices),
        "involuntary_churn": analyses.involuntary_churn(customers, events),
        "unpaid_by_plan": analyses.unpaid_by_plan(invoices),
        "kpi_latest": dashboard.kpi_latest(months, dashboard.export_unpaid(invoices)),
        "plan_churn_table": dashboard.plan_churn_table(dashboard.export_plans(customers)),
        "cohort_matrix": dashboard.cohort_matrix(dashboard.export_cohorts(retention)),
    }


def as_of(spark: SparkSession, warehouse: str, at: datetime) -> DataFrame:
    """What the stored history says was in force at an instant."""
    return state_as_of(load_marts(spark, f"{warehouse}/marts", ["dim_subscription_history"])["dim_subscription_history"], at)


def feed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(source_pos, data) of a folder of array files, oldest first; positions run the other way, as in a feed.

    Files are numbered, not their rows: nothing is sorted but one row per file.
    """
    rows = array_elements(spark, folder)
    order = Window.orderBy("file")
    numbers = rows.select("file").distinct().select("file", F.row_number().over(order).cast("bigint").alias("n"))
    place = F.shiftleft(F.col("n"), 40) + F.col("pos")
    return rows.join(numbers, "file").select((-place).alias("source_pos"), "data")


def bounds_of(text: str) -> tuple[float | None, float | None]:
    """``low:high``, either of them empty for an open end."""
    low, _, high = text.partition(":")
    return tuple(float(x) if x else None for x in (low, high))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    steps = ["sync", "load", "stream", "build", "check", "export", "analyze", "as-of"]
    parser.add_argument("step", choices=steps)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--feed", help="folder of JSON-array files of change events, oldest first")
    parser.add_argument("--full", action="store_true", help="sync or load everything, whatever was read before")
    parser.add_argument("--landing")
    parser.add_argument("--out")
    parser.add_argument("--at", type=datetime.fromisoformat, help="instant for as-of")
    for name in BOUNDS:
        parser.add_argument(f"--{name}", type=bounds_of, metavar="LOW:HIGH", help=f"what check accepts for {name}")
    args = parser.parse_args(argv)
    spark = build_session()
    now = datetime.now(timezone.utc).replace(microsecond=0)
    if args.step == "sync":
        sync_feed(spark, feed_rows(spark, args.feed), args.landing, f"{args.warehouse}/state", now, args.full)
    elif args.step == "load":
        load_all(spark, args.landing, args.warehouse, now, only_new=not args.full).show(truncate=False)
    elif args.step == "stream":
        stream_load(spark, args.landing, f"{args.warehouse}/changes", f"{args.warehouse}/checkpoints/changes")
        fold_stream(spark, args.warehouse, now)
    elif args.step == "build":
        build(spark, args.warehouse, now)
    elif args.step == "check":
        return run_check(spark, args.warehouse, now, {n: getattr(args, n) for n in BOUNDS if getattr(args, n)})
    elif args.step == "analyze":
        for name, frame in analyze(spark, args.warehouse).items():
            frame.write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.step == "as-of":
        as_of(spark, args.warehouse, args.at).write.mode("overwrite").parquet(args.out)
    else:
        export(spark, args.warehouse, now).coalesce(1).write.mode("overwrite").text(args.out)
    return 0


def run_check(spark: SparkSession, warehouse: str, now: datetime, limits: dict) -> int:
    """Prints all test results; 1 if any fails."""
    report = check_all(spark, warehouse, **limits).collect()  # one row per rule
    for row in sorted(report, key=lambda r: (r.passed, r.table_name)):
        print(*row)
    ages = freshness(raw_tables(spark, warehouse), now).collect()  # one row per table
    series = all_marts(spark, warehouse)["mrr_monthly"]
    summary = dashboard_check(dashboard.export_mrr_series(series)).first()
    print(*ages, summary, sep="\n")
    return int(not (all(r.passed for r in report) and all(r.status != "error" for r in ages) and summary.passed))


if __name__ == "__main__":
    raise SystemExit(main())
