"""Dimensions and facts: plans, customers, invoices, lifecycle events, subscription history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.functions.calendar import month_of
from subtally.functions.numeric import round_scaled
from subtally.operators.neighbours import TASK_ROWS, with_neighbours

SNAPSHOT_CHECK = ("status", "plan_key", "canceled_at")


MONTHLY = (
    f"CASE billing_interval WHEN 'year' THEN cast({round_scaled('cast(price_amount AS double) / 12', 2)} AS decimal(12,2)) "
    "ELSE price_amount END"
)


def dim_plan(stg_subscriptions: DataFrame) -> DataFrame:
    """One row per price seen on a current subscription; yearly prices become monthly amounts."""
    attributes = ["price_id", "plan_key", "plan_name", "billing_interval", "price_amount"]
    return (
        stg_subscriptions.select(*attributes)
        .distinct()
        .selectExpr(*attributes, f"{MONTHLY} AS mrr_amount")
    )


def plan_prices(event_prices: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(plan_key, mrr_amount, valid_from, valid_to): what each plan cost when, as the events themselves tell.

    A price holds from the first event that shows it until another one is seen; of two at one instant that of the later
    event id counts. Before a plan was first seen it counts at its first price, so that interval has no beginning. A plan
    may be on a large share of all events, so neighbours are found by stretches; price changes are few.
    """
    seen = event_prices.filter("plan_key IS NOT NULL AND seen_at IS NOT NULL AND price_amount IS NOT NULL")
    at_once = seen.groupBy("plan_key", "seen_at").agg(F.expr(f"max_by({MONTHLY}, event_id)").alias("mrr_amount"))
    steps = with_neighbours(at_once, "plan_key", ("seen_at",), ("mrr_amount",), previous="before", task_rows=task_rows)
    changes = steps.filter("before IS NULL OR before.mrr_amount <> mrr_amount")
    by_time = "OVER (PARTITION BY plan_key ORDER BY seen_at)"
    return changes.selectExpr(
        "plan_key", "mrr_amount", "if(before IS NULL, NULL, seen_at) AS valid_from", f"lead(seen_at) {by_time} AS valid_to"
    )


def customer_subscription_rollup(stg_subscriptions: DataFrame) -> DataFrame:
    """First start, and the newest subscription's plan, status and last known reason.

    The newest non-null value wins, so a customer who came back keeps the last reason given.
    """

    def newest_known(name: str) -> str:
        return (
            f"max_by({name}, struct(started_at, subscription_id)) "
            f"FILTER (WHERE {name} IS NOT NULL AND started_at IS NOT NULL)"
        )

    return stg_subscriptions.groupBy("customer_id").agg(
        F.min("started_at").alias("first_subscribed_at"),
        F.expr(newest_known("plan_key")).alias("current_plan_key"),
        F.expr(newest_known("status")).alias("subscription_status"),
        F.max("canceled_at").alias("canceled_at"),
        F.expr(newest_known("cancellation_reason")).alias("cancellation_reason"),
    )


def customer_invoice_rollup(fct_invoices: DataFrame) -> DataFrame:
    return fct_invoices.groupBy("customer_id").agg(
        F.sum("amount_paid").alias("lifetime_revenue"),
        F.count("*").alias("invoice_count"),
        F.expr("count_if(NOT is_paid)").alias("unpaid_invoice_count"),
    )


def dim_customer(stg_customers: DataFrame, stg_subscriptions: DataFrame, fct_invoices: DataFrame) -> DataFrame:
    subs = customer_subscription_rollup(stg_subscriptions)
    invoices = customer_invoice_rollup(fct_invoices)
    return (
        stg_customers.join(subs, "customer_id", "left")
        .join(invoices, "customer_id", "left")
        .selectExpr(
            "customer_id",
            "customer_name",
            "email",
            "created_at",
            f"{month_of('first_subscribed_at')} AS cohort_month",
            "current_plan_key",
            "subscription_status",
            "canceled_at",
            "cancellation_reason",
            "coalesce(lifetime_revenue, 0) AS lifetime_revenue",
            "coalesce(invoice_count, 0) AS invoice_count",
            "coalesce(unpaid_invoice_count, 0) AS unpaid_invoice_count",
        )
    )


def fct_invoices(stg_invoices: DataFrame, plans: DataFrame) -> DataFrame:
    attributes = plans.select("price_id", "plan_key", "plan_name", "billing_interval")
    return stg_invoices.join(attributes, "price_id", "left").selectExpr(
        "invoice_id",
        "customer_id",
        "subscription_id",
        "plan_key",
        "plan_name",
        "billing_interval",
        "billing_reason",
        "status",
        "status = 'paid' AS is_paid",
        "created_at",
        f"{month_of('period_start')} AS invoice_month",
        "period_start",
        "period_end",
        "paid_at",
        "amount_due",
        "amount_paid",
        "cast(amount_due - amount_paid AS decimal(12,2)) AS amount_unpaid",
        "attempt_count",
    )


# The event types that open and end a subscription.
CREATED, DELETED = "customer.subscription.created", "customer.subscription.deleted"


def fct_subscription_events(
    stg_subscription_events: DataFrame, stg_subscriptions: DataFrame, plans: DataFrame
) -> DataFrame:
    """Starts, plan changes and cancellations with the MRR on either side.

    Plans come from current subscriptions only, so an event about a plan nobody holds any more has
    no MRR and an update to or from it cannot be classified. Unclassified events drop out, before
    the only shuffle of this plan.
    """
    known = stg_subscriptions.select("subscription_id")
    return classified(stg_subscription_events, plans).join(known, "subscription_id", "left_semi").select(*LIFECYCLE)


# The columns of the mart.
LIFECYCLE = (
    "event_id",
    "subscription_id",
    "customer_id",
    "event_type",
    "occurred_at",
    "plan_key",
    "previous_plan_key",
    "mrr_before",
    "mrr_after",
)


def fct_subscription_events_at_own_prices(
    stg_subscription_events: DataFrame, stg_subscriptions: DataFrame, prices: DataFrame
) -> DataFrame:
    """The same with the prices of ``plan_prices`` as of each event: plans that nobody holds any more have theirs too."""

    def as_of(side: str, key: str) -> tuple[DataFrame, Column]:
        own = prices.selectExpr(f"plan_key AS plan_{side}", f"mrr_amount AS mrr_{side}", f"valid_from AS from_{side}", f"valid_to AS to_{side}")
        began = f"(from_{side} IS NULL OR from_{side} <= period_start)"
        return own, F.expr(f"{key} = plan_{side} AND {began} AND (to_{side} IS NULL OR period_start < to_{side})")

    now, then = as_of("now", "plan_key"), as_of("then", "previous_plan_key")
    priced = stg_subscription_events.join(*now, "left").join(*then, "left")
    known = stg_subscriptions.select("subscription_id")
    return lifecycle_rows(priced).join(known, "subscription_id", "left_semi").select(*LIFECYCLE)


def classified(stg_subscription_events: DataFrame, plans: DataFrame) -> DataFrame:
    """The lifecycle rows of all events, whether their subscription is known or not."""
    now = plans.selectExpr("plan_key", "plan_key AS plan_now", "mrr_amount AS mrr_now")
    then = plans.selectExpr("plan_key AS previous_plan_key", "plan_key AS plan_then", "mrr_amount AS mrr_then")
    return lifecycle_rows(stg_subscription_events.join(now, "plan_key", "left").join(then, "previous_plan_key", "left"))


def lifecycle_rows(priced: DataFrame) -> DataFrame:
    """Of events with (plan_now, mrr_now, plan_then, mrr_then) those that are steps of a subscription's life."""
    own = priced.withColumn("step", lifecycle_step()).filter("step IS NOT NULL")
    return own.selectExpr(
        "event_id",
        "subscription_id",
        "customer_id",
        "step.event_type",
        "step.occurred_at",
        "plan_now AS plan_key",
        "plan_then AS previous_plan_key",
        "step.mrr_before",
        "step.mrr_after",
    )


def lifecycle_step() -> Column:
    """What an event does to a subscription: its kind, when, and the MRR that it takes from one value to another.

    The API names starts and ends; other events are told by the direction of the price, and are nothing without one.
    """
    mrr_now, mrr_then, nothing = F.col("mrr_now"), F.col("mrr_then"), F.lit(0).cast("decimal(12,2)")

    def step(kind: str, at: str, before: Column, after: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("event_type"),
            F.col(at).alias("occurred_at"),
            before.cast("decimal(12,2)").alias("mrr_before"),
            after.cast("decimal(12,2)").alias("mrr_after"),
        )

    return (
        F.when(F.col("event_type") == CREATED, step("started", "period_start", F.coalesce(mrr_then, nothing), mrr_now))
        .when(F.col("event_type") == DELETED, step("canceled", "canceled_at", mrr_now, nothing))
        .when(mrr_now > mrr_then, step("upgraded", "period_start", mrr_then, mrr_now))
        .when(mrr_now < mrr_then, step("downgraded", "period_start", mrr_then, mrr_now))
    )


def mrr_segments(fct_events: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Each event opens an interval of constant MRR that the subscription's next event closes."""
    return with_neighbours(
        fct_events.select("customer_id", "subscription_id", "event_id", "occurred_at", "mrr_after"),
        key="subscription_id",
        order=("occurred_at", "event_id"),
        carry=("occurred_at",),
        following="next_event",
        task_rows=task_rows,
    ).selectExpr(
        "customer_id",
        "subscription_id",
        "event_id",
        "occurred_at AS valid_from",
        "next_event.occurred_at AS valid_to",
        "mrr_after AS mrr",
    )


def dim_subscription_history(snapshot: DataFrame, plans: DataFrame) -> DataFrame:
    attributes = plans.select("plan_key", "plan_name", "billing_interval", "mrr_amount")
    intervals = snapshot.select("subscription_id", "customer_id", "status", "plan_key", "valid_from", "valid_to")
    return intervals.join(attributes, "plan_key", "left").selectExpr(
        "subscription_id",
        "customer_id",
        "status",
        "plan_key",
        "plan_name",
        "billing_interval",
        "mrr_amount",
        "valid_from",
        "valid_to",
        "valid_to IS NULL AS is_current",
    )
