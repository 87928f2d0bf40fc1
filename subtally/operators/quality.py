"""Data tests: every rule reports how many rows or values break it, and passes at zero.

Rules that look at one row at a time, and counts of rows, share a single aggregation per table. Rules about repeated values
share one aggregation for all tables and a type of values: these are stacked as (rule, value).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    name = "not_null"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """NULL passes."""

    table: str
    column: str
    values: tuple[str, ...]
    name = "accepted_values"

    def broken(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class ValuesBetween:
    """NULL passes; an open end is None."""

    table: str
    column: str
    low: float | None = None
    high: float | None = None
    name = "values_between"

    def broken(self) -> Column:
        value, outside = F.col(self.column), F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low)
        if self.high is not None:
            outside = outside | (value > self.high)
        return outside


@dataclass(frozen=True)
class Unique:
    """Counts the non-null values that occur more than once."""

    table: str
    column: str
    name = "unique"


@dataclass(frozen=True)
class Relationship:
    """Counts child rows whose non-null key has no parent."""

    table: str
    column: str
    parent: str
    parent_column: str
    name = "relationships"


@dataclass(frozen=True)
class RowCountBetween:
    table: str
    low: int | None = None
    high: int | None = None
    column: str | None = None
    name = "row_count_between"


@dataclass(frozen=True)
class OneCurrentRow:
    """Counts keys with more than one open row."""

    table: str
    column: str
    flag: str = "is_current"
    name = "one_current_row"


Rule = NotNull | AcceptedValues | ValuesBetween | Unique | Relationship | RowCountBetween | OneCurrentRow


def _row(rule: Rule, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).cast("string").alias("column_name"),
        failed.cast("bigint").alias("n_failed"),
        (failed == 0).alias("passed"),
    )


def _rowwise(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    def failures(rule: Rule) -> Column:
        if not isinstance(rule, RowCountBetween):
            return F.count_if(rule.broken())
        rows, outside = F.count(F.lit(1)), F.lit(False)
        if rule.low is not None:
            outside = outside | (rows < rule.low)
        if rule.high is not None:
            outside = outside | (rows > rule.high)
        return outside.cast("int")

    counted = table.agg(*[failures(rule).alias(f"r{i}") for i, rule in enumerate(rules)])
    return counted.select(F.inline(F.array(*[_row(rule, F.col(f"r{i}")) for i, rule in enumerate(rules)])))


# Types whose equal values read alike as text, and whose values that read alike are equal.
WHOLE = ("bigint", "int", "smallint", "tinyint", "date")


def _repeated(
    tables: dict[str, DataFrame], rules: Sequence[Unique | OneCurrentRow], columns: dict[tuple[str, str], DataFrame]
) -> DataFrame:
    """How many values occur more than once; values of one type are stacked, so that rules share an exchange and a table
    is read once for each of its types. Whole numbers and dates aren't made text, which costs more to group and to move."""
    frames: dict[tuple, tuple[DataFrame, list[tuple[str, Column]]]] = {}
    for i, rule in enumerate(rules):
        cheap = (rule.table, rule.column) if isinstance(rule, Unique) and (rule.table, rule.column) in columns else None
        frame, values = frames.setdefault(cheap or (rule.table,), (columns[cheap] if cheap else tables[rule.table], []))
        kind = frame.select(rule.column).dtypes[0][1]
        value = F.col(rule.column) if kind in WHOLE else F.col(rule.column).cast("string")
        own = F.when(F.col(rule.flag), value) if isinstance(rule, OneCurrentRow) else value
        values.append((kind if kind in WHOLE else "string", F.struct(F.lit(i).alias("rule"), own.alias("value"))))
    stacks: dict[str, list[DataFrame]] = {}
    for frame, values in frames.values():
        for kind in dict.fromkeys(k for k, _ in values):
            stacks.setdefault(kind, []).append(frame.select(F.inline(F.array(*[v for k, v in values if k == kind]))))
    counted = []
    for parts in stacks.values():
        counts = reduce(DataFrame.unionByName, parts).filter("value IS NOT NULL").groupBy("rule", "value").agg(F.count("*").alias("n"))
        counted.append(counts.groupBy("rule").agg(F.count_if(F.col("n") > 1).alias("n")))
    failures = reduce(DataFrame.unionByName, counted)  # a row per rule that has values
    failed = failures.agg(*[F.coalesce(F.max(F.when(F.col("rule") == i, F.col("n"))), F.lit(0)).alias(f"r{i}") for i in range(len(rules))])
    return failed.select(F.inline(F.array(*[_row(rule, F.col(f"r{i}")) for i, rule in enumerate(rules)])))


def _orphans(tables: dict[str, DataFrame], rule: Relationship) -> DataFrame:
    # Count the children per key first, so a hot key is one row in the join.
    children = (
        tables[rule.table]
        .filter(F.col(rule.column).isNotNull())
        .groupBy(F.col(rule.column).alias("k"))
        .agg(F.count("*").alias("n"))
    )
    parents = tables[rule.parent].select(F.col(rule.parent_column).alias("k"))
    counted = children.join(parents, "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counted.select(F.inline(F.array(_row(rule, F.col("n")))))


def check(
    tables: dict[str, DataFrame], rules: Sequence[Rule], columns: dict[tuple[str, str], DataFrame] | None = None
) -> DataFrame:
    """One row (rule, table_name, column_name, n_failed, passed) per rule.

    ``columns`` may hold, by table and column, a cheaper frame of that column alone for rules that need no more.
    """
    rowwise: dict[str, list[Rule]] = {}
    repeated, parts = [], []
    for rule in rules:
        if isinstance(rule, (Unique, OneCurrentRow)):
            repeated.append(rule)
        elif isinstance(rule, Relationship):
            parts.append(_orphans(tables, rule))
        else:
            rowwise.setdefault(rule.table, []).append(rule)
    parts += [_rowwise(tables[name], group) for name, group in rowwise.items()]
    if repeated:
        parts.append(_repeated(tables, repeated, columns or {}))
    return reduce(DataFrame.unionByName, parts)


def freshness(
    raw: dict[str, DataFrame], now: datetime, warn_days: float = 2, error_days: float = 7
) -> DataFrame:
    """Age of each raw table's newest load; a table never loaded is an error."""
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("loaded_at")
    status = (
        F.when(F.col("loaded_at").isNull() | (age > error_days * 86400), "error")
        .when(age > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    parts = [
        frame.agg(F.max("loaded_at").alias("loaded_at")).select(
            F.lit(name).alias("table_name"), "loaded_at", status.alias("status")
        )
        for name, frame in sorted(raw.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def dashboard_check(mrr_series: DataFrame, min_months: int = 12) -> DataFrame:
    """The export must carry enough months and end on a month with revenue."""
    summary = mrr_series.agg(F.count("*").alias("months"), F.max_by("mrr", "month").alias("latest_mrr"))
    return summary.withColumn(
        "passed", (F.col("months") >= min_months) & F.coalesce(F.col("latest_mrr") > 0, F.lit(False))
    )


# The states the billing API and the marts know.
SUBSCRIPTION_STATUSES = ("active", "past_due", "canceled", "unpaid", "trialing", "incomplete")
INVOICE_STATUSES = ("draft", "open", "paid", "void", "uncollectible")
LIFECYCLE_TYPES = ("started", "upgraded", "downgraded", "canceled")
MOVEMENT_TYPES = ("new", "expansion", "contraction", "churn", "reactivation")


def key_rules() -> list[Rule]:
    """unique and not_null on every key column."""
    keys = [
        ("stg_customers", "customer_id"),
        ("stg_subscriptions", "subscription_id"),
        ("stg_invoices", "invoice_id"),
        ("stg_charges", "charge_id"),
        ("stg_subscription_events", "event_id"),
        ("dim_plan", "price_id"),
        ("dim_plan", "plan_key"),
        ("dim_customer", "customer_id"),
        ("fct_invoices", "invoice_id"),
        ("fct_subscription_events", "event_id"),
        ("mrr_monthly", "month"),
    ]
    more = [
        ("stg_subscriptions", "customer_id"),
        ("dim_subscription_history", "subscription_id"),
        ("dim_subscription_history", "valid_from"),
    ]
    return [Unique(*k) for k in keys] + [NotNull(*k) for k in keys + more]


def value_rules() -> list[Rule]:
    return [
        AcceptedValues("stg_subscriptions", "status", SUBSCRIPTION_STATUSES),
        AcceptedValues("stg_invoices", "status", INVOICE_STATUSES),
        AcceptedValues("fct_subscription_events", "event_type", LIFECYCLE_TYPES),
        AcceptedValues("mrr_customer_monthly", "movement", MOVEMENT_TYPES),
        Relationship("fct_invoices", "customer_id", "dim_customer", "customer_id"),
        OneCurrentRow("dim_subscription_history", "subscription_id"),
    ]


def size_rules(
    customers: tuple[int | None, int | None] = (1, None),
    months: tuple[int | None, int | None] = (1, None),
    mrr: tuple[float | None, float | None] = (0, None),
    active: tuple[int | None, int | None] = (0, None),
) -> list[Rule]:
    """Bounds that depend on the size of the business are the caller's."""
    return [
        RowCountBetween("dim_customer", *customers),
        RowCountBetween("mrr_monthly", *months),
        ValuesBetween("mrr_monthly", "mrr", *mrr),
        ValuesBetween("mrr_monthly", "active_customers", *active),
        ValuesBetween("mrr_monthly", "churn_mrr", None, 0),
    ]


def declared_rules(**bounds) -> list[Rule]:
    """All 36 tests of a build."""
    return key_rules() + value_rules() + size_rules(**bounds)
