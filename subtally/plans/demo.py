"""The billing model over the demo documents, one lazily built frame per staging view and mart."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from subtally.operators.history import scd2_rebuild
from subtally.plans import dashboard, marts, revenue, staging
from subtally.session import prepare, shared_dir
from subtally.sources import demo_billing
from subtally.sources.tables import save_mart


class Book:
    """Frames are built on first use, so a query carries only the plan it needs.

    Marts named in ``keep`` are written to the shared folder and read back, as the tables they are in
    production: right for a query that reads one more than once. So are the larger views, whose documents are parsed
    once then.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.keep = keep

    def _mart(self, name: str, frame: DataFrame) -> DataFrame:
        return self.stored(name, frame) if name in self.keep else frame

    def stored(self, name: str, frame: DataFrame) -> DataFrame:
        return save_mart(frame, shared_dir(self.spark, "marts"), name)

    def raw(self, name: str) -> DataFrame:
        return demo_billing.RAW[name](self.spark, self.sf_dir)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw("customers"))

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return self._mart("stg_subscriptions", staging.stg_subscriptions(self.raw("subscriptions")))

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return self._mart("stg_invoices", staging.stg_invoices(self.raw("invoices")))

    @cached_property
    def stg_charges(self) -> DataFrame:
        return staging.stg_charges(self.raw("charges"))

    @cached_property
    def stg_subscription_events(self) -> DataFrame:
        return self._mart("stg_subscription_events", staging.stg_subscription_events(self.raw("events")))

    @cached_property
    def plans(self) -> DataFrame:
        """dim_plan as a table, as in production: a few rows that several joins read."""
        return self.stored("dim_plan", self.dim_plan)

    @cached_property
    def subscription_ids(self) -> DataFrame:
        return staging.ids(self.raw("subscriptions"), "subscription_id")

    @cached_property
    def customer_ids(self) -> DataFrame:
        return staging.ids(self.raw("customers"), "customer_id")

    @cached_property
    def dim_plan(self) -> DataFrame:
        return marts.dim_plan(self.stg_subscriptions)

    @cached_property
    def fct_invoices(self) -> DataFrame:
        return self._mart("fct_invoices", marts.fct_invoices(self.stg_invoices, self.plans))

    @cached_property
    def fct_subscription_events(self) -> DataFrame:
        events = marts.fct_subscription_events(self.stg_subscription_events, self.subscription_ids, self.plans)
        return self._mart("fct_subscription_events", events)

    @cached_property
    def dim_customer(self) -> DataFrame:
        customers = marts.dim_customer(self.stg_customers, self.stg_subscriptions, self.fct_invoices)
        return self._mart("dim_customer", customers)

    @cached_property
    def mrr_customer_monthly(self) -> DataFrame:
        return revenue.mrr_customer_monthly(self.customer_ids, self.fct_subscription_events)

    @cached_property
    def mrr_monthly(self) -> DataFrame:
        return self._mart("mrr_monthly", revenue.mrr_monthly(self.customer_ids, self.fct_subscription_events))

    @cached_property
    def snapshot(self) -> DataFrame:
        """Subscription history as monthly snapshot runs would have recorded it."""
        batches = demo_billing.subscription_snapshots(self.spark, self.sf_dir, "month")
        return scd2_rebuild(batches, "subscription_id", marts.SNAPSHOT_CHECK, "run")

    @cached_property
    def dim_subscription_history(self) -> DataFrame:
        history = marts.dim_subscription_history(self.snapshot, self.plans)
        return self._mart("dim_subscription_history", history)

    @cached_property
    def retention(self) -> DataFrame:
        return self._mart("retention", dashboard.cohort_retention(self.dim_customer, self.fct_subscription_events))

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in names}
