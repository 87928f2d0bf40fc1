"""Typed views over raw documents, one row per object.

Each document is parsed once, with an explicit schema that names only what the view needs, so no key
can be lost to inference. Leaves are read as text and cast: a number and a quoted number read the same
way, and bad input raises under ANSI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from subtally.functions.documents import cents, epoch, first_item, parse_once

CUSTOMER = "struct<name:string,email:string,created:string,delinquent:string>"

PRICE = (
    "struct<id:string,lookup_key:string,product:string,unit_amount:string,"
    "recurring:struct<`interval`:string>>"
)

SUBSCRIPTION = f"""struct<
    customer:string, status:string, start_date:string, canceled_at:string,
    items:struct<data:array<struct<price:{PRICE}>>>,
    cancellation_details:struct<reason:string>>"""

INVOICE = """struct<
    customer:string, status:string, billing_reason:string, created:string,
    amount_due:string, amount_paid:string, attempt_count:string,
    parent:struct<subscription_details:struct<subscription:string>>,
    status_transitions:struct<paid_at:string>,
    lines:struct<data:array<struct<
        pricing:struct<price_details:struct<price:string>>,
        period:struct<start:string,`end`:string>>>>>"""

CHARGE = """struct<
    customer:string, payment_intent:string, status:string, amount:string,
    created:string, failure_code:string>"""

SUBSCRIPTION_EVENT = """struct<
    type:string,
    data:struct<
        object:struct<
            id:string, customer:string, canceled_at:string,
            items:struct<data:array<struct<price:struct<lookup_key:string>,current_period_start:string>>>>,
        previous_attributes:struct<items:struct<data:array<struct<price:struct<lookup_key:string>>>>>>>"""


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    return parse_once(raw.select("id", "data"), "data", schema, "d")


def ids(raw: DataFrame, name: str) -> DataFrame:
    """The objects' ids alone, without parsing a document."""
    return raw.select(raw["id"].alias(name))


def stg_customers(raw: DataFrame) -> DataFrame:
    return _parsed(raw, CUSTOMER).selectExpr(
        "id AS customer_id",
        "d.name AS customer_name",
        "d.email AS email",
        f"{epoch('d.created')} AS created_at",
        "cast(d.delinquent AS boolean) AS is_delinquent",
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    price = f"{first_item('d.items.data')}.price"
    return _parsed(raw, SUBSCRIPTION).selectExpr(
        "id AS subscription_id",
        "d.customer AS customer_id",
        "d.status AS status",
        f"{price}.id AS price_id",
        f"{price}.lookup_key AS plan_key",
        f"{price}.product AS plan_name",
        f"{price}.recurring.`interval` AS billing_interval",
        f"{cents(f'{price}.unit_amount')} AS price_amount",
        f"{epoch('d.start_date')} AS started_at",
        f"{epoch('d.canceled_at')} AS canceled_at",
        "d.cancellation_details.reason AS cancellation_reason",
    )


def stg_invoices(raw: DataFrame) -> DataFrame:
    line = first_item("d.lines.data")
    return _parsed(raw, INVOICE).selectExpr(
        "id AS invoice_id",
        "d.customer AS customer_id",
        "d.parent.subscription_details.subscription AS subscription_id",
        f"{line}.pricing.price_details.price AS price_id",
        "d.status AS status",
        "d.billing_reason AS billing_reason",
        f"{epoch('d.created')} AS created_at",
        f"{epoch(f'{line}.period.start')} AS period_start",
        f"{epoch(f'{line}.period.`end`')} AS period_end",
        f"{epoch('d.status_transitions.paid_at')} AS paid_at",
        f"{cents('d.amount_due')} AS amount_due",
        f"{cents('d.amount_paid')} AS amount_paid",
        "cast(d.attempt_count AS int) AS attempt_count",
    )


def stg_charges(raw: DataFrame) -> DataFrame:
    return _parsed(raw, CHARGE).selectExpr(
        "id AS charge_id",
        "d.customer AS customer_id",
        "d.payment_intent AS payment_intent_id",
        "d.status AS status",
        f"{cents('d.amount')} AS amount",
        f"{epoch('d.created')} AS created_at",
        "d.failure_code AS failure_code",
    )


def stg_subscription_events(raw: DataFrame) -> DataFrame:
    """Subscription events only; previous_plan_key is NULL unless the plan changed."""
    item = first_item("d.data.object.items.data")
    before = first_item("d.data.previous_attributes.items.data")
    return (
        _parsed(raw, SUBSCRIPTION_EVENT)
        .filter("startswith(d.type, 'customer.subscription.')")
        .selectExpr(
            "id AS event_id",
            "d.type AS event_type",
            "d.data.object.id AS subscription_id",
            "d.data.object.customer AS customer_id",
            f"{before}.price.lookup_key AS previous_plan_key",
            f"{item}.price.lookup_key AS plan_key",
            f"{epoch(f'{item}.current_period_start')} AS period_start",
            f"{epoch('d.data.object.canceled_at')} AS canceled_at",
        )
    )


EVENT_PRICE = f"""struct<
    type:string, data:struct<object:struct<items:struct<data:array<struct<price:{PRICE}, current_period_start:string>>>>>>"""


def event_prices(raw: DataFrame) -> DataFrame:
    """(event_id, plan_key, billing_interval, price_amount, seen_at): the price that each subscription event itself carries."""
    item = first_item("d.data.object.items.data")
    return (
        _parsed(raw, EVENT_PRICE)
        .filter("startswith(d.type, 'customer.subscription.')")
        .selectExpr(
            "id AS event_id",
            f"{item}.price.lookup_key AS plan_key",
            f"{item}.price.recurring.`interval` AS billing_interval",
            f"{cents(f'{item}.price.unit_amount')} AS price_amount",
            f"{epoch(f'{item}.current_period_start')} AS seen_at",
        )
    )


STAGING = {
    "stg_customers": (stg_customers, "customers"),
    "stg_subscriptions": (stg_subscriptions, "subscriptions"),
    "stg_invoices": (stg_invoices, "invoices"),
    "stg_charges": (stg_charges, "charges"),
    "stg_subscription_events": (stg_subscription_events, "events"),
}


def id_columns(raw: dict[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """By view and key column: the keys of the views that keep every document, read without parsing any."""
    keys = {"customers": "customer_id", "subscriptions": "subscription_id", "invoices": "invoice_id", "charges": "charge_id"}
    return {(f"stg_{name}", key): ids(raw[name], key) for name, key in keys.items()}


def staging_views(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: view(raw[source]) for name, (view, source) in STAGING.items()}
