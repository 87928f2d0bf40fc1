"""

Every query reads the whole of the given tables. Results are presented in types both engines print
alike: money as DOUBLE, counts as BIGINT, dates and times as text.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from subtally import job  # noqa: E402
from subtally.functions.numeric import finite  # noqa: E402
from subtally.operators import history, ingest, intervals, quality  # noqa: E402
from subtally.plans import analyses, dashboard, marts, refresh, revenue, staging  # noqa: E402
from subtally.plans.demo import Book  # noqa: E402
from subtally.plans.staging import id_columns  # noqa: E402
from subtally.session import prepare, shared_dir  # noqa: E402
from subtally.sources import demo_billing, landing, state  # noqa: E402
from subtally.sources.tables import save_mart  # noqa: E402
from subtally.streaming.history import read_stream_history, stream_history  # noqa: E402
from subtally.streaming.load import read_changes, stream_load  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

SINCE = 1705276800  # 2024-01-15T00:00:00Z
SPLIT_DAY = "2024-01-16"
AS_OF = datetime(1998, 3, 15)
NOW = datetime(2024, 2, 2)
FIRST_SYNC, SECOND_SYNC = datetime(2024, 1, 20, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc)


def presented(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        kind, column = field.dataType.typeName(), F.col(field.name)
        if kind == "decimal":
            column = column.cast("double")
        elif kind in ("integer", "short", "byte"):
            column = column.cast("bigint")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def k_of(data: str = "data"):
    return F.get_json_object(data, "$.k").cast("int").alias("k")


# --- ingest -----------------------------------------------------------------------------------


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_feed(demo_billing.change_feed(prepare(spark), sf_dir))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.route_snapshots(feed(spark, sf_dir)).select(
        "type", "id", F.col("batch").alias("file"), (-F.col("source_pos")).alias("pos"), "data"
    )


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(prepare(spark), "landing") + "/events"
    demo_billing.write_feed_files(spark, sf_dir, root)
    sync, block = landing.sync_of().alias("sync"), F.split("file", "/")[1].cast("bigint").alias("block")
    k = F.get_json_object("data", "$.data.object.k").cast("int").alias("k")
    return landing.raw_scan(spark, root).select(sync, block, "pos", "id", k)


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.latest_snapshot(routed(spark, sf_dir), by=("type", "id")).select("type", "id", k_of())


def upsert_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = routed(spark, sf_dir)
    old = ingest.latest_snapshot(rows.filter(F.col("file") < SPLIT_DAY))
    new = ingest.latest_snapshot(rows.filter(F.col("file") >= SPLIT_DAY))
    target = ingest.upsert(None, old, datetime(2024, 1, 16))
    return ingest.upsert(target, new, datetime(2024, 1, 31)).select("id", k_of(), "loaded_at")


def landed(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    root = shared_dir(prepare(spark), "landing")
    for name in names:
        rows = demo_billing.RAW[name](spark, sf_dir).withColumn("pos", F.monotonically_increasing_id())
        landing.write_landing(rows, root, name, "2031-04-17T08-09-10Z")
    return root


def load_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed(spark, sf_dir, landing.OBJECT_TYPES)
    warehouse = shared_dir(spark, "warehouse")
    return job.load_all(spark, root, warehouse, datetime(2026, 9, 4)).select("type", "n_rows")


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed(spark, sf_dir, ("charges",))
    rows = landing.scan_landing(spark, f"{root}/charges")
    return rows.select(
        F.col("file").alias("sync"),
        "id",
        F.get_json_object("data", "$.amount").cast("bigint").alias("amount"),
        F.get_json_object("data", "$.failure_code").alias("failure_code"),
    )


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.incremental_filter(feed(spark, sf_dir), SINCE).select("event_id", "event_type", "created", "seq")


def next_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    survivors = ingest.drop_dead_clock_cascade(ingest.incremental_filter(feed(spark, sf_dir), SINCE))
    return ingest.next_cursor(survivors, SINCE)


def dead_clock_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.drop_dead_clock_cascade(feed(spark, sf_dir)).select("batch", "event_id", "event_type", "test_clock")


def route_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.route_snapshots(feed(spark, sf_dir)).select("type", "id", "batch", "created", k_of())


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(prepare(spark), "stream")
    demo_billing.write_feed_files(spark, sf_dir, f"{root}/landing/events")
    stream_load(spark, f"{root}/landing/events", f"{root}/changes", f"{root}/checkpoint", max_files=16)
    k = F.coalesce(F.get_json_object("data", "$.k"), F.get_json_object("data", "$.data.object.k"))
    return read_changes(spark, f"{root}/changes").select("type", "id", k.cast("int").alias("k"))


def sync_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full sync, then one of what came since; the state that the next would start from."""
    root = shared_dir(prepare(spark), "sync")
    rows = demo_billing.change_feed(spark, sf_dir).select("source_pos", "data")
    for at in (FIRST_SYNC, SECOND_SYNC):
        job.sync_feed(spark, rows, f"{root}/landing", f"{root}/state", at)
    known = state.load_state(spark, f"{root}/state")
    return spark.range(1).select(F.lit(known["cursor"]).alias("cursor"), F.lit(known["last_sync"]).alias("last_sync"))


def sample_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = demo_billing.raw_documents(prepare(spark), sf_dir)
    return ingest.sample_by_parent(raw, k=2).select("type", "id")


def refreshed(read: Callable[[SparkSession, str, DataFrame], DataFrame]) -> Query:
    """Revenue tables built after a first sync and refreshed after a second one.

    The first has nine tenths of all objects; the second the others, and some that were there already.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_dir(prepare(spark), "refresh")
        landing_dir, warehouse = f"{root}/landing", f"{root}/warehouse"
        kinds = ("customers", "subscriptions", "events")
        # Both syncs land parts of the same documents, which are made once.
        raw = {name: save_mart(demo_billing.RAW[name](spark, sf_dir), f"{root}/made", name) for name in kinds}
        for day, part in enumerate(("pmod(xxhash64(id), 10) < 9", "pmod(xxhash64(id), 10) >= 8"), 1):
            for name in kinds:
                rows = raw[name].filter(part).withColumn("pos", F.monotonically_increasing_id())
                landing.write_landing(rows, landing_dir, name, f"2026-09-0{day}T00-00-00Z")
            job.load_all(spark, landing_dir, warehouse, datetime(2026, 9, day, 6), only_new=True)
            staged = staging.stg_subscriptions(job.raw_tables(spark, warehouse)["subscriptions"])
            plans = save_mart(marts.dim_plan(staged), f"{root}/marts", "dim_plan", str(day))
            tables = job.refresh_revenue(spark, warehouse, f"2026-09-0{day}T07-00-00Z", plans)
        customers = staging.ids(job.raw_tables(spark, warehouse)["customers"], "customer_id")
        return read(spark, tables, customers)

    return query


# --- history ----------------------------------------------------------------------------------


def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly snapshot runs folded through the stored history, oldest first."""
    root = shared_dir(prepare(spark), "snapshots")
    batches = save_mart(demo_billing.subscription_snapshots(spark, sf_dir, "year"), root, "batches")
    runs = sorted(r.run for r in batches.select("run").distinct().collect())  # one per year
    for run in runs:
        batch = batches.filter(F.col("run") == F.lit(run)).drop("run")
        history.snapshot_run(spark, f"{root}/history", batch, "subscription_id", marts.SNAPSHOT_CHECK, run)
    return history.read_history(spark, f"{root}/history")


def history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly snapshots that arrive in three lots, each taken up by a stream that starts again."""
    root = shared_dir(prepare(spark), "history-stream")
    batches = save_mart(demo_billing.subscription_snapshots(spark, sf_dir, "month"), root, "batches")
    for lot in ("run < '1994-01-01'", "run >= '1994-01-01' AND run < '1997-01-01'", "run >= '1997-01-01'"):
        batches.filter(lot).write.mode("append").parquet(f"{root}/landing")
        stream_history(
            spark, f"{root}/landing", batches.schema, f"{root}/history", f"{root}/checkpoint", "subscription_id", marts.SNAPSHOT_CHECK
        )
    return read_stream_history(spark, f"{root}/history", batches.schema)


def history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.state_as_of(Book(spark, sf_dir).dim_subscription_history, AS_OF)
    return rows.select("subscription_id", "customer_id", "status", "plan_key", "mrr_amount", "valid_from", "valid_to")


def history_as_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan that was in force at every order, and at its ship dates: questions on, before and after every change."""
    b = Book(spark, sf_dir)
    months = demo_billing.subscription_snapshots(b.spark, sf_dir, "month").select("subscription_id", F.col("run").alias("at"))
    orders = demo_billing.orders(b.spark, sf_dir).selectExpr("subscription AS subscription_id", "cast(o_orderdate AS timestamp) AS at")
    asked = orders.unionByName(months).distinct()
    history_rows = b.dim_subscription_history.select("subscription_id", "status", "plan_key", "mrr_amount", "valid_from", "valid_to")
    return intervals.state_as_of_many(history_rows, asked, "subscription_id")


# --- marts, dashboard, analyses ---------------------------------------------------------------


EVENTS, CUSTOMERS, INVOICES, MONTHS = "fct_subscription_events", "dim_customer", "fct_invoices", "mrr_monthly"
STAGED_EVENTS, STAGED_INVOICES, STAGED_SUBSCRIPTIONS = "stg_subscription_events", "stg_invoices", "stg_subscriptions"


def book(build: Callable[[Book], DataFrame], *keep: str) -> Query:
    """A query over the billing model; the marts in ``keep`` are read more than once, so stored."""
    return lambda spark, sf_dir: build(Book(spark, sf_dir, keep))


def cohorts(b: Book) -> DataFrame:
    return dashboard.export_cohorts(b.retention)


def plan_table(b: Book) -> DataFrame:
    table = dashboard.plan_churn_table(dashboard.export_plans(b.dim_customer))
    return table.selectExpr("* EXCEPT (churn_pct)", f"{finite('churn_pct')} AS churn_pct")


def ltv(b: Book) -> DataFrame:
    table = analyses.ltv_by_plan(
        b.plans,
        analyses.customer_months_by_plan(b.dim_customer, b.fct_subscription_events),
        analyses.cancellations_by_plan(b.fct_subscription_events),
        b.dim_customer,
    )
    measures = ("monthly_churn_pct", "expected_lifetime_months", "expected_ltv")
    others = [c for c in table.columns if c not in measures]
    return table.selectExpr(
        *others, "expected_ltv = double('Infinity') AS is_infinite", *[f"{finite(m)} AS {m}" for m in measures]
    )


def payload(b: Book) -> DataFrame:
    document = dashboard.dashboard_payload(
        "2026-11-28T06:00:00+00:00",
        dashboard.export_mrr_series(b.mrr_monthly),
        dashboard.export_plans(b.dim_customer),
        cohorts(b),
        dashboard.export_unpaid(b.fct_invoices),
    )
    return dashboard.payload_rows(document)


# --- quality ----------------------------------------------------------------------------------


def rules_of(kind: type, b: Book, *extra: quality.Rule, **more: DataFrame) -> DataFrame:
    rules = [r for r in quality.declared_rules() if isinstance(r, kind)]
    tables = b.tables(*{r.table for r in rules}, *{r.parent for r in rules if isinstance(r, quality.Relationship)})
    raw = {name: b.raw(name) for name in landing.OBJECT_TYPES}
    return quality.check({**tables, **more}, [*rules, *extra], id_columns(raw))


def dq_unique(b: Book) -> DataFrame:
    lines = demo_billing.read_table(b.spark, b.sf_dir, "lineitem")
    return rules_of(quality.Unique, b, quality.Unique("lineitem", "l_orderkey"), lineitem=lines)


def dq_not_null(b: Book) -> DataFrame:
    return rules_of(
        quality.NotNull, b, quality.NotNull("dim_customer", "cohort_month"), quality.NotNull("stg_invoices", "paid_at")
    )


def dq_accepted_values(b: Book) -> DataFrame:
    narrow = quality.AcceptedValues("stg_invoices", "billing_reason", ("subscription_cycle",))
    return rules_of(quality.AcceptedValues, b, narrow)


def dq_relationships(b: Book) -> DataFrame:
    canceled = b.stg_subscriptions.filter(F.col("status") == "canceled")
    orphan = quality.Relationship("fct_invoices", "subscription_id", "canceled_subscriptions", "subscription_id")
    return rules_of(quality.Relationship, b, orphan, canceled_subscriptions=canceled)


def dq_row_count(b: Book) -> DataFrame:
    return rules_of(quality.RowCountBetween, b, quality.RowCountBetween("mrr_monthly", 12, 60))


def dq_values_between(b: Book) -> DataFrame:
    return rules_of(quality.ValuesBetween, b, quality.ValuesBetween("mrr_monthly", "mrr", 0, 50000))


def dq_one_current_row(b: Book) -> DataFrame:
    return rules_of(quality.OneCurrentRow, b)


def dq_freshness(b: Book) -> DataFrame:
    stamps = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    raw = {
        name: demo_billing.read_table(b.spark, b.sf_dir, name).select(F.col(c).cast("timestamp").alias("loaded_at"))
        for name, c in stamps.items()
    }
    return quality.freshness(raw, NOW)


def llm_part():
    """The module with the training-data queries, or None where that subpackage isn't there."""
    if importlib.util.find_spec("subtally.llm") is None or importlib.util.find_spec("subtally.llm.queries") is None:
        return None
    return importlib.import_module("subtally.llm.queries")


def queries() -> dict[str, Query]:
    part = llm_part()
    return {**core_queries(), **(part.queries() if part else {})}


def core_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        # ingest
        "raw_scan": raw_scan,
        "latest_snapshot": latest_snapshot,
        "upsert_raw": upsert_raw,
        "load_all_counts": load_all_counts,
        "landing_roundtrip": landing_roundtrip,
        "incremental_events": incremental_events,
        "next_cursor": next_cursor,
        "dead_clock_suppression": dead_clock_suppression,
        "route_snapshots": route_snapshots,
        "stream_upsert": stream_upsert,
        "sync_state": sync_state,
        "sample_by_parent": sample_by_parent,
        # staging
        "stg_customers": book(lambda b: b.stg_customers),
        "stg_subscriptions": book(lambda b: b.stg_subscriptions),
        "stg_invoices": book(lambda b: b.stg_invoices),
        "stg_charges": book(lambda b: b.stg_charges),
        "stg_subscription_events": book(lambda b: b.stg_subscription_events),
        # marts
        "dim_plan": book(lambda b: b.dim_plan),
        "customer_subscription_rollup": book(lambda b: marts.customer_subscription_rollup(b.stg_subscriptions)),
        "customer_invoice_rollup": book(lambda b: marts.customer_invoice_rollup(b.fct_invoices)),
        "dim_customer": book(lambda b: b.dim_customer),
        "fct_invoices": book(lambda b: b.fct_invoices),
        "fct_subscription_events": book(lambda b: b.fct_subscription_events),
        "plan_prices": book(lambda b: marts.plan_prices(staging.event_prices(b.raw("events")))),
        "fct_subscription_events_own_prices": book(
            lambda b: marts.fct_subscription_events_at_own_prices(
                b.stg_subscription_events, b.subscription_ids, b.stored("plan_prices", marts.plan_prices(staging.event_prices(b.raw("events"))))
            )
        ),
        "mrr_segments": book(lambda b: marts.mrr_segments(b.fct_subscription_events)),
        "month_spine": book(lambda b: revenue.month_spine(b.fct_subscription_events)),
        "customer_month_grid": book(
            lambda b: revenue.customer_month_grid(b.customer_ids, b.fct_subscription_events), EVENTS
        ),
        "month_end_mrr": book(lambda b: revenue.month_end_mrr(b.customer_ids, b.fct_subscription_events), EVENTS),
        "month_end_mrr_join": book(
            lambda b: revenue.month_end_mrr_join(
                b.customer_ids, b.fct_subscription_events, marts.mrr_segments(b.fct_subscription_events)
            ),
            EVENTS,
        ),
        "mrr_customer_monthly": book(lambda b: b.mrr_customer_monthly, EVENTS),
        "mrr_monthly": book(lambda b: b.mrr_monthly),
        "mrr_monthly_refresh": refreshed(lambda spark, tables, customers: refresh.mrr_monthly(spark, tables)),
        "mrr_customer_monthly_refresh": refreshed(refresh.mrr_customer_monthly),
        "scd2_incremental": scd2_incremental,
        "history_stream": history_stream,
        "scd2_rebuild": book(lambda b: b.snapshot),
        "dim_subscription_history": book(lambda b: b.dim_subscription_history),
        "history_as_of": history_as_of,
        "history_as_of_many": history_as_of_many,
        # dashboard
        "export_mrr_series": book(lambda b: dashboard.export_mrr_series(b.mrr_monthly)),
        "export_plans": book(lambda b: dashboard.export_plans(b.dim_customer)),
        "export_cohorts": book(cohorts, EVENTS),
        "export_unpaid": book(lambda b: dashboard.export_unpaid(b.fct_invoices)),
        "kpi_latest": book(lambda b: dashboard.kpi_latest(b.mrr_monthly, dashboard.export_unpaid(b.fct_invoices))),
        "plan_churn_table": book(plan_table),
        "cohort_matrix": book(lambda b: dashboard.cohort_matrix(cohorts(b)), EVENTS),
        "dashboard_payload": book(payload, EVENTS, CUSTOMERS, INVOICES, STAGED_SUBSCRIPTIONS),
        # analyses
        "waterfall_long": book(lambda b: analyses.waterfall_long(b.mrr_monthly)),
        "monthly_churn_rate": book(lambda b: analyses.monthly_churn_rate(b.mrr_monthly)),
        "plan_status_crosstab": book(lambda b: analyses.plan_status_crosstab(b.dim_customer)),
        "plan_reason_crosstab": book(lambda b: analyses.plan_reason_crosstab(b.dim_customer)),
        "cohort_pivot": book(lambda b: analyses.cohort_pivot(b.retention), EVENTS, "retention"),
        "customer_months_by_plan": book(
            lambda b: analyses.customer_months_by_plan(b.dim_customer, b.fct_subscription_events), EVENTS
        ),
        "cancellations_by_plan": book(lambda b: analyses.cancellations_by_plan(b.fct_subscription_events)),
        "ltv_by_plan": book(ltv, EVENTS, CUSTOMERS),
        "charges_by_status": book(lambda b: analyses.charges_by_status(b.stg_charges)),
        "unpaid_summary": book(lambda b: analyses.unpaid_summary(b.fct_invoices)),
        "involuntary_churn": book(lambda b: analyses.involuntary_churn(b.dim_customer, b.fct_subscription_events)),
        "unpaid_by_plan": book(lambda b: analyses.unpaid_by_plan(b.fct_invoices)),
        # quality
        "dq_unique": book(dq_unique, EVENTS, INVOICES, CUSTOMERS, STAGED_EVENTS, STAGED_SUBSCRIPTIONS),
        "dq_not_null": book(
            dq_not_null, EVENTS, INVOICES, CUSTOMERS, STAGED_EVENTS, STAGED_INVOICES, STAGED_SUBSCRIPTIONS
        ),
        "dq_accepted_values": book(dq_accepted_values, EVENTS),
        "dq_relationships": book(dq_relationships, INVOICES),
        "dq_row_count": book(dq_row_count, MONTHS),
        "dq_values_between": book(dq_values_between),
        "dq_one_current_row": book(dq_one_current_row),
        "dq_freshness": book(dq_freshness),
        "dq_dashboard": book(lambda b: quality.dashboard_check(dashboard.export_mrr_series(b.mrr_monthly))),
    }

    def finished(query: Query) -> Query:
        return lambda spark, sf_dir: presented(query(spark, sf_dir))

    return {name: finished(query) for name, query in named.items()}


def oracle_sql() -> dict[str, str]:
    part = llm_part()
    return {**oracle.statements(), **(part.statements() if part else {})}


def entry(spark: SparkSession) -> DataFrame:
    """The monthly revenue waterfall, from documents to marts."""
    return core_queries()["mrr_monthly"](spark, "/root/testdata/sf0.001")
