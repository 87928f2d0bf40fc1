"""The questions the revenue notebook asks of the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.functions.calendar import months_between
from subtally.functions.numeric import ratio, round_half_even
from subtally.plans.revenue import MOVEMENTS, bounds, customer_month_deltas, with_movement

def waterfall_long(mrr_monthly: DataFrame) -> DataFrame:
    return mrr_monthly.unpivot(["month"], [f"{m}_mrr" for m in MOVEMENTS], "movement", "amount")


def monthly_churn_rate(mrr_monthly: DataFrame) -> DataFrame:
    # The window holds one row per calendar month.
    before = mrr_monthly.selectExpr("month", "churned_customers", "lag(active_customers) OVER (ORDER BY month) AS active")
    return before.selectExpr("month", f"{ratio('churned_customers', 'active')} AS churn_rate")


def crosstab(dim_customer: DataFrame, column: str) -> DataFrame:
    """(current_plan_key, column, customers): a row for every pair of values that occurs, whatever the values are."""
    known = dim_customer.filter(F.col("current_plan_key").isNotNull() & F.col(column).isNotNull())
    return known.groupBy("current_plan_key", column).agg(F.count("*").alias("customers"))


def plan_status_crosstab(dim_customer: DataFrame) -> DataFrame:
    """Customers per plan and status; the share canceled is of all the plan's statuses, to one digit."""
    own = "OVER (PARTITION BY current_plan_key)"  # one row per status
    counted = crosstab(dim_customer, "subscription_status").selectExpr(
        "*",
        f"sum(customers) {own} AS total",
        f"sum(if(subscription_status = 'canceled', customers, 0)) {own} AS canceled",
    )
    share = f"({ratio('canceled', 'total')}) * 100"
    return counted.selectExpr("* EXCEPT (total, canceled)", f"{round_half_even(share, 1)} AS churn_pct").orderBy(
        F.col("churn_pct").desc(), "current_plan_key", "subscription_status"
    )


def plan_reason_crosstab(dim_customer: DataFrame) -> DataFrame:
    return crosstab(dim_customer, "cancellation_reason")


def cohort_pivot(retention: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    """Cohorts as rows and months since signup as columns m0, m1, ...

    Without ``months`` the width is read from the data first: one number.
    """
    if months is None:
        longest = retention.agg(F.max("months_since")).first()[0]
        months = range((longest if longest is not None else -1) + 1)
    cells = retention.selectExpr(
        "date_format(cohort_month, 'yyyy-MM') AS cohort",
        "months_since",
        f"{ratio('n_active', 'n_customers')} AS share",
    )
    pivoted = cells.groupBy("cohort").pivot("months_since", list(months)).agg(F.max("share"))
    return pivoted.select("cohort", *[F.col(str(m)).alias(f"m{m}") for m in months])


def customer_months_by_plan(dim_customer: DataFrame, fct_events: DataFrame) -> DataFrame:
    """Paying customer-months by the customer's current plan.

    Counted as the length of each paying stretch, so the customer x month table is not built.
    """
    plans = dim_customer.select("customer_id", "current_plan_key").filter("current_plan_key IS NOT NULL")
    return (
        with_movement(customer_month_deltas(fct_events).join(plans, "customer_id"))
        .filter("mrr > 0")
        .select("current_plan_key", "month", "next_month", bounds(fct_events))
        .selectExpr(
            "current_plan_key",
            f"{months_between('month', 'coalesce(next_month, add_months(ends.last_month, 1))')} AS months",
        )
        .groupBy("current_plan_key")
        .agg(F.sum("months").alias("customer_months"))
    )


def cancellations_by_plan(fct_events: DataFrame) -> DataFrame:
    return (
        fct_events.filter("event_type = 'canceled' AND plan_key IS NOT NULL")
        .groupBy("plan_key")
        .agg(F.count("*").alias("cancellations"))
    )


def ltv_by_plan(
    plans: DataFrame, customer_months: DataFrame, cancellations: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Expected and realized lifetime value; a plan nobody ever left is worth infinity."""
    realized = dim_customer.groupBy(F.col("current_plan_key").alias("plan_key")).agg(
        F.expr("cast(sum(lifetime_revenue) AS double) / count(*)").alias("realized_revenue_per_customer")
    )
    months = customer_months.withColumnRenamed("current_plan_key", "plan_key")
    return (
        plans.select("plan_key", "plan_name", "billing_interval", "mrr_amount")
        .join(months, "plan_key", "left")
        .join(cancellations, "plan_key", "left")
        .join(realized, "plan_key", "left")
        .na.fill(0, ["mrr_amount", "customer_months", "cancellations"])
        .selectExpr("*", f"({ratio('cancellations', 'customer_months')}) * 100 AS monthly_churn_pct")
        .selectExpr("*", f"{ratio('100.0D', 'monthly_churn_pct')} AS expected_lifetime_months")
        .selectExpr("*", "cast(mrr_amount AS double) * expected_lifetime_months AS expected_ltv")
        .orderBy(F.col("expected_ltv").desc_nulls_last())
    )


def charges_by_status(stg_charges: DataFrame) -> DataFrame:
    return stg_charges.groupBy("status").agg(F.count("*").alias("charges"), F.sum("amount").alias("amount"))


def unpaid_summary(fct_invoices: DataFrame) -> DataFrame:
    return fct_invoices.filter("NOT is_paid").selectExpr(
        "count(*) AS unpaid_invoices", "coalesce(sum(amount_unpaid), 0) AS unpaid_amount"
    )


def involuntary_churn(dim_customer: DataFrame, fct_events: DataFrame) -> DataFrame:
    """Customers lost to failed payments and the MRR their cancellations took along."""
    lost = dim_customer.filter("cancellation_reason = 'payment_failed'").select("customer_id")
    # Sum per customer before the join, so a customer with many cancellations is one row in it.
    canceled = (
        fct_events.filter("event_type = 'canceled'").groupBy("customer_id").agg(F.sum("mrr_before").alias("mrr"))
    )
    return (
        lost.join(canceled, "customer_id", "left")
        .selectExpr("count(*) AS lost_customers", "coalesce(sum(mrr), 0) AS lost_mrr")
        .selectExpr("*", "lost_mrr * 12 AS lost_mrr_annualised")
    )


def unpaid_by_plan(fct_invoices: DataFrame) -> DataFrame:
    return (
        fct_invoices.filter("NOT is_paid AND plan_name IS NOT NULL")
        .groupBy("plan_name")
        .agg(F.sum("amount_unpaid").alias("amount_unpaid"))
        .orderBy(F.col("amount_unpaid").desc())
    )
