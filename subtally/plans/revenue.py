"""Monthly recurring revenue.

A customer's MRR only moves in months with an event, so the work runs on those months: the last
event of each subscription and month, differenced, summed per customer, and accumulated. Every
window here holds one key's months, at most as many rows as the calendar has months, whatever the
number of events. The dense customer x month table is unfolded at the very end, inside the task that
already holds the customer, with no join against a grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.functions.calendar import month_of, month_range, months_between
from subtally.operators.intervals import covering

MOVEMENTS = ("new", "expansion", "reactivation", "contraction", "churn")


def event_month_bounds(fct_events: DataFrame) -> DataFrame:
    """First and last month with a lifecycle event, the ends of every monthly series."""
    return fct_events.selectExpr(
        f"min({month_of('occurred_at')}) AS first_month", f"max({month_of('occurred_at')}) AS last_month"
    )


def bounds(fct_events: DataFrame) -> Column:
    """Both ends as a scalar subquery: one aggregate, usable in any row."""
    return event_month_bounds(fct_events).selectExpr("struct(first_month, last_month)").scalar().alias("ends")


def month_spine(fct_events: DataFrame) -> DataFrame:
    return event_month_bounds(fct_events).selectExpr(f"explode({month_range('first_month', 'last_month')}) AS month_start")


def customer_month_grid(stg_customers: DataFrame, fct_events: DataFrame) -> DataFrame:
    """Every customer in every month, unfolded next to the customer row.

    A customer is a few bytes before and a row a month afterwards, so customers are dealt out evenly first: the splits
    of their file say nothing about the work.
    """
    return (
        stg_customers.select("customer_id")
        .hint("rebalance")
        .select("customer_id", bounds(fct_events))
        .selectExpr("customer_id", f"explode({month_range('ends.first_month', 'ends.last_month')}) AS month_start")
        .selectExpr("*", "add_months(month_start, 1) AS next_month_start")
    )


def subscription_deltas(fct_events: DataFrame, *also: str) -> DataFrame:
    """(customer_id, subscription_id, month, delta): what each subscription changes in the months in which anything happened.

    Only the last event of a subscription's month is still open at the month's end. An event
    without a time opens nothing and, sorting last, closes nothing. ``also`` names columns that follow from the
    subscription; rows that are dealt by one of them stay where they are, and are sorted by them first.
    """
    key = ", ".join((*also, "subscription_id"))
    last_of_month = (
        fct_events.filter("occurred_at IS NOT NULL")
        .groupBy(*also, "subscription_id", F.expr(month_of("occurred_at")).alias("month"))
        .agg(
            F.expr(
                """max_by(struct(customer_id, cast(coalesce(mrr_after, 0) AS decimal(22,2)) AS mrr),
                          struct(occurred_at, event_id))"""
            ).alias("now")
        )
    )
    return last_of_month.selectExpr("*", f"lag(now) OVER (PARTITION BY {key} ORDER BY month) AS then").selectExpr(
        *also,
        "subscription_id",
        "month",
        """inline(filter(
             array(struct(now.customer_id AS customer_id, now.mrr AS delta),
                   struct(then.customer_id AS customer_id, cast(-then.mrr AS decimal(22,2)) AS delta)),
             d -> d.delta IS NOT NULL))""",
    )


def summed(deltas: DataFrame, *also: str) -> DataFrame:
    """Change of each customer's month-end MRR, from those of its subscriptions; ``also`` follows from the customer."""
    return deltas.groupBy(*also, "customer_id", "month").agg(F.expr("cast(sum(delta) AS decimal(22,2))").alias("delta"))


def customer_month_deltas(fct_events: DataFrame) -> DataFrame:
    return summed(subscription_deltas(fct_events))


def with_movement(deltas: DataFrame, *also: str) -> DataFrame:
    """Accumulate the deltas of each customer and name the movement of each change; ``also`` follows from the customer."""
    months = f"PARTITION BY {', '.join((*also, 'customer_id'))} ORDER BY month"
    return (
        deltas.selectExpr(
            "*",
            f"cast(sum(delta) OVER ({months}) AS decimal(22,2)) AS mrr",
            f"lead(month) OVER ({months}) AS next_month",
            f"lag(month) OVER ({months}) IS NULL AS is_first",
        )
        .selectExpr(
            "*",
            "cast(mrr - delta AS decimal(22,2)) AS previous_mrr",
            f"coalesce(max(mrr) OVER ({months} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS peak",
        )
        .selectExpr(
            "* EXCEPT (peak, delta)",
            # Down: did anything remain? Up: did anything stand before, and if not, had the customer ever paid?
            """if(delta < 0, if(mrr = 0, 'churn', 'contraction'),
                  if(delta > 0, if(previous_mrr <> 0, 'expansion', if(peak > 0, 'reactivation', 'new')), NULL)) AS movement""",
        )
    )


def mrr_customer_monthly(stg_customers: DataFrame, fct_events: DataFrame) -> DataFrame:
    """Customer x month: month-end MRR, the month before, and the movement between them."""
    changes = with_movement(stg_customers.select("customer_id").join(customer_month_deltas(fct_events), "customer_id", "left"))
    return unfolded(changes, bounds(fct_events))


def unfolded(changes: DataFrame, ends: Column) -> DataFrame:
    """Each change row unfolds into the months until the next change; the first one also covers the
    months before it, and a customer without events, whose one row has no month, covers them all at zero.
    """
    return (
        changes.select("*", ends)
        .selectExpr(
            "*",
            "if(is_first, ends.first_month, month) AS start",
            "coalesce(add_months(next_month, -1), ends.last_month) AS until",
        )
        # Counting months and adding the count costs a fraction of a sequence of dates.
        .selectExpr("*", f"explode(if(start <= until, sequence(0, {months_between('start', 'until')}), NULL)) AS _n")
        .selectExpr("*", "add_months(start, _n) AS cell")
        .selectExpr("*", "if(cell >= month, coalesce(mrr, 0), 0) AS now_mrr")
        .selectExpr(
            "customer_id",
            "cell AS month",
            "now_mrr AS mrr",
            "if(cell = month, previous_mrr, now_mrr) AS previous_mrr",
            "if(cell = month, cast(now_mrr - previous_mrr AS decimal(22,2)), 0) AS mrr_change",
            "if(cell = month, movement, NULL) AS movement",
        )
    )


def month_end_mrr(stg_customers: DataFrame, fct_events: DataFrame) -> DataFrame:
    return mrr_customer_monthly(stg_customers, fct_events).selectExpr("customer_id", "month AS month_start", "mrr")


def month_end_mrr_join(stg_customers: DataFrame, fct_events: DataFrame, segments: DataFrame) -> DataFrame:
    """The same by its definition: every cell of the grid with the segments that are open at the month's end.

    An interval join; useful where segments come from elsewhere and changes alone can't be summed.
    """
    grid = customer_month_grid(stg_customers, fct_events)
    open_then = covering(
        grid, segments.select("customer_id", "valid_from", "valid_to", "mrr"), ["customer_id"], "next_month_start",
        "valid_from", "valid_to", closed="right",
    )
    return open_then.groupBy("customer_id", "month_start").agg(F.expr("cast(coalesce(sum(mrr), 0) AS decimal(22,2))").alias("mrr"))


def mrr_monthly(stg_customers: DataFrame, fct_events: DataFrame) -> DataFrame:
    """Monthly waterfall straight from the changes, without the customer x month table."""
    changes = with_movement(customer_month_deltas(fct_events).transform(marked_known, stg_customers))
    return series(month_flows(changes))


def marked_known(rows: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Changes of unknown customers count for nothing, but their months still stretch the calendar."""
    return rows.join(stg_customers.selectExpr("customer_id", "true AS is_known"), "customer_id", "left")


FLOWS = [f"{kind}_mrr" for kind in MOVEMENTS] + ["new_customers", "churned_customers"]


def month_flows(changes: DataFrame) -> DataFrame:
    """What the changes of each month add up to. Every column is a sum, so flows of disjoint sets of customers add."""
    return changes.groupBy("month").agg(
        F.count("*").alias("n_changes"),
        F.expr("cast(coalesce(sum(mrr - previous_mrr) FILTER (WHERE is_known), 0) AS decimal(32,2))").alias("change"),
        F.expr("coalesce(sum(int(mrr > 0) - int(previous_mrr > 0)) FILTER (WHERE is_known), 0)").alias("turned"),
        *[
            F.expr(
                f"cast(coalesce(sum(mrr - previous_mrr) FILTER (WHERE is_known AND movement = '{kind}'), 0)"
                " AS decimal(22,2))"
            ).alias(f"{kind}_mrr")
            for kind in MOVEMENTS
        ],
        F.expr("count_if(is_known AND movement = 'new')").alias("new_customers"),
        F.expr("count_if(is_known AND movement = 'churn')").alias("churned_customers"),
    )


def series(flows: DataFrame) -> DataFrame:
    """A month's totals are the running sums of the flows up to it. There is one row per month, so the
    unpartitioned window sees the calendar and nothing else.
    """
    return (
        flows.selectExpr(
            "month AS changed",
            "cast(sum(change) OVER (ORDER BY month) AS decimal(22,2)) AS mrr",
            "sum(turned) OVER (ORDER BY month) AS active_customers",
            "coalesce(add_months(lead(month) OVER (ORDER BY month), -1), month) AS until",
            *FLOWS,
        )
        .selectExpr("*", f"explode({month_range('changed', 'until')}) AS month")
        .selectExpr(
            "month", "mrr", "active_customers", *[f"if(month = changed, {flow}, 0) AS {flow}" for flow in FLOWS]
        )
        .orderBy("month")
    )
