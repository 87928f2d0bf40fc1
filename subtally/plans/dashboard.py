"""Aggregates behind the dashboard and the JSON document it reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.functions.calendar import months_between
from subtally.functions.numeric import ratio, round_scaled
from subtally.plans.revenue import bounds, customer_month_deltas, with_movement

SERIES = (
    "mrr",
    "active_customers",
    "new_mrr",
    "expansion_mrr",
    "reactivation_mrr",
    "contraction_mrr",
    "churn_mrr",
    "new_customers",
    "churned_customers",
)


def export_mrr_series(mrr_monthly: DataFrame) -> DataFrame:
    return mrr_monthly.select(F.col("month").cast("string").alias("month"), *SERIES).orderBy("month")


def export_plans(dim_customer: DataFrame) -> DataFrame:
    """Customers per current plan; those without a subscription form a NULL plan, listed last."""
    return (
        dim_customer.groupBy(F.col("current_plan_key").alias("plan"))
        .agg(
            F.expr("count_if(subscription_status = 'active')").alias("active"),
            F.expr("count_if(subscription_status = 'canceled')").alias("canceled"),
            F.expr("count_if(cancellation_reason = 'cancellation_requested')").alias("cancellation_requested"),
            F.expr("count_if(cancellation_reason = 'payment_failed')").alias("payment_failed"),
        )
        .orderBy(F.col("plan").asc_nulls_last())
    )


def cohort_retention(dim_customer: DataFrame, fct_events: DataFrame) -> DataFrame:
    """(cohort_month, months_since, n_active, n_customers) for every month from the cohort's on.

    All customers of a cohort share the same months, so the cohort's size is the denominator and
    the active count is a running sum of customers turning active or inactive. After the first
    aggregations the rows number cohorts x months.
    """
    cohorts = dim_customer.select("customer_id", "cohort_month").filter("cohort_month IS NOT NULL")
    turns = (
        with_movement(customer_month_deltas(fct_events).join(cohorts, "customer_id"))
        .selectExpr(
            "cohort_month",
            f"greatest({months_between('cohort_month', 'month')}, 0) AS months_since",
            "int(mrr > 0) - int(previous_mrr > 0) AS turned",
        )
        .groupBy("cohort_month", "months_since")
        .agg(F.sum("turned").alias("turned"))
    )
    cells = (
        cohorts.groupBy("cohort_month")
        .agg(F.count("*").alias("n_customers"))
        .select("*", bounds(fct_events))
        .selectExpr(
            "cohort_month",
            "n_customers",
            f"greatest({months_between('cohort_month', 'ends.first_month')}, 0) AS first",
            f"{months_between('cohort_month', 'ends.last_month')} AS last",
        )
        .selectExpr(
            "cohort_month", "n_customers", "explode(if(first <= last, sequence(first, last), NULL)) AS months_since"
        )
    )
    return cells.join(turns, ["cohort_month", "months_since"], "left").selectExpr(
        "cohort_month",
        "months_since",
        "sum(coalesce(turned, 0)) OVER (PARTITION BY cohort_month ORDER BY months_since) AS n_active",
        "n_customers",
    )


def export_cohorts(retention: DataFrame) -> DataFrame:
    """Share of each signup month still paying, rounded to two digits."""
    return retention.selectExpr(
        "date_format(cohort_month, 'yyyy-MM') AS cohort",
        "months_since",
        f"{round_scaled(ratio('n_active', 'n_customers'), 2)} AS retained",
    ).orderBy("cohort", "months_since")


def export_unpaid(fct_invoices: DataFrame) -> DataFrame:
    return fct_invoices.filter("NOT is_paid").selectExpr("coalesce(sum(amount_unpaid), 0) AS unpaid_amount")


def kpi_latest(mrr_monthly: DataFrame, unpaid: DataFrame) -> DataFrame:
    """The tiles: the latest month against the one before, in one row."""
    before = "lag({}) OVER (ORDER BY month)"  # one row per calendar month
    latest = (
        mrr_monthly.selectExpr(
            "month",
            "mrr",
            f"mrr - {before.format('mrr')} AS mrr_delta",
            "active_customers",
            "new_customers",
            "churned_customers",
            f"{before.format('active_customers')} AS active_before",
        )
        .orderBy(F.col("month").desc())
        .limit(1)
    )
    return latest.select("*", unpaid.scalar().alias("unpaid_amount")).selectExpr(
        "* EXCEPT (active_before)",
        "CASE WHEN mrr_delta >= 0 THEN 'up' WHEN mrr_delta < 0 THEN 'down' END AS direction",
        f"{ratio('churned_customers', 'active_before')} AS churn_rate",
    )


def plan_churn_table(plans: DataFrame) -> DataFrame:
    """Churn share of each plan among its active and canceled customers."""
    return (
        plans.selectExpr("plan", "active", "canceled", "active + canceled AS total")
        .selectExpr("*", f"{ratio('canceled', 'total')} * 100 AS churn_pct")
        .orderBy(F.col("churn_pct").desc_nulls_last())
    )


def cohort_matrix(cohorts: DataFrame) -> DataFrame:
    """Every cohort against 0..longest, NULL where a cohort is too young.

    One map per cohort, at most one entry per calendar month.
    """
    return (
        cohorts.groupBy("cohort")
        .agg(
            F.expr("map_from_entries(collect_list(struct(months_since, retained)))").alias("shares"),
            F.max("months_since").alias("oldest"),
        )
        .selectExpr("cohort", "shares", "max(oldest) OVER () AS longest")
        .selectExpr("cohort", "shares", "explode(sequence(0, longest)) AS months_since")
        .selectExpr("cohort", "months_since", "try_element_at(shares, months_since) AS retained")
    )


def listed(frame: DataFrame, *order: str) -> Column:
    """All rows as one array of structs, by the given columns, NULL last; amounts as plain numbers."""
    plain = [F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in frame.dtypes]
    key = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(f"by_{c}"))])
    rows = F.sort_array(F.collect_list(F.struct(key.alias("key"), F.struct(*plain).alias("row"))))
    return frame.agg(F.transform(rows, lambda r: r["row"])).scalar()


def dashboard_payload(
    generated_at: str, mrr_series: DataFrame, plans: DataFrame, cohorts: DataFrame, unpaid: DataFrame
) -> DataFrame:
    """The dashboard document as one JSON row: months, plans and cohort cells, a few thousand at most."""
    document = F.struct(
        F.lit(generated_at).alias("generated_at"),
        listed(mrr_series, "month").alias("mrr_monthly"),
        listed(plans, "plan").alias("plans"),
        listed(cohorts, "cohort", "months_since").alias("cohorts"),
        unpaid.select(F.col("unpaid_amount").cast("double")).scalar().alias("unpaid_amount"),
    )
    return mrr_series.sparkSession.range(1).select(F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"))


PAYLOAD = f"""struct<generated_at:string, mrr_monthly:array<struct<month:string, {", ".join(f"{c}:double" for c in SERIES)}>>,
    plans:array<struct<plan:string, active:double, canceled:double, cancellation_requested:double, payment_failed:double>>,
    cohorts:array<struct<cohort:string, months_since:int, retained:double>>, unpaid_amount:double>"""


def payload_rows(payload: DataFrame) -> DataFrame:
    """(section, n, item, months_since, measure, value): what a reader of the document finds, n by its order."""
    read = payload.select(F.from_json("payload", " ".join(PAYLOAD.split()), {"mode": "FAILFAST"}).alias("d"))

    def section(name: str, item: str, months: str, measures: Sequence[str]) -> DataFrame:
        rows = read.select(F.posexplode(f"d.{name}").alias("n", "x"))
        pairs = ", ".join(f"struct('{m}' AS measure, x.{m} AS value)" for m in measures)
        return rows.selectExpr(f"'{name}' AS section", "n", f"x.{item} AS item", f"{months} AS months_since", f"inline(array({pairs}))")

    unpaid = read.selectExpr("'unpaid' AS section", "0 AS n", "cast(NULL AS string) AS item", "cast(NULL AS int) AS months_since", "'unpaid_amount' AS measure", "d.unpaid_amount AS value")
    parts = [
        section("mrr_monthly", "month", "cast(NULL AS int)", SERIES),
        section("plans", "plan", "cast(NULL AS int)", ("active", "canceled", "cancellation_requested", "payment_failed")),
        section("cohorts", "cohort", "x.months_since", ("retained",)),
        unpaid,
    ]
    return reduce(DataFrame.unionByName, parts)
