"""Billing documents derived from the order tables, in the shape the billing API sends.

Customers and suppliers become accounts (suppliers never order, so they have no subscription).
Orders of one customer with the same key parity form a subscription, and each order is one event on
it: the first creates it, a final one with status F deletes it, the rest change its plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subtally.operators.neighbours import TASK_ROWS, with_neighbours

# The demo price list, by order key modulo its length.
PLANS = [
    ("solo_monthly", 1250),
    ("solo_yearly", 13500),
    ("team_monthly", 3700),
    ("team_yearly", 40400),
    ("fleet_monthly", 21500),
    ("fleet_yearly", 230000),
]
PLAN_KEYS = "array({})".format(", ".join(f"'{key}'" for key, _ in PLANS))
PLAN_CENTS = "array({})".format(", ".join(str(cents) for _, cents in PLANS))

# Rows one landing file of the demo feed holds at most; what the files mean does not depend on it.
FILE_ROWS = 20_000


# The driver's tables. Reading with a schema saves the job that looks for one.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Building and parsing JSON costs far more than moving these narrow rows, so they are dealt out evenly first."""
    return df.hint("rebalance")


def padded(prefix: str, number: str) -> str:
    """Zero-padded ids, so they sort as text the way the numbers do."""
    text = f"cast({number} AS string)"
    return f"concat('{prefix}', lpad({text}, greatest(12, length({text})), '0'))"


def price(index: str) -> str:
    key = f"get({PLAN_KEYS}, cast({index} AS int))"
    return f"""named_struct(
        'id', concat('price_', cast({index} AS string)),
        'lookup_key', {key},
        'product', concat('prod_', substring_index({key}, '_', 1)),
        'unit_amount', get({PLAN_CENTS}, cast({index} AS int)),
        'recurring', named_struct('interval', if({index} % 2 = 0, 'month', 'year')))"""


def subscription_ids(custkey: str, parity: str) -> tuple[str, str]:
    return (
        f"{padded('cus_', custkey)} AS customer",
        f"concat({padded('sub_', custkey)}, '_', cast({parity} AS string)) AS subscription",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        "o_orderpriority = '5-LOW' AS untimed",
        f"o_orderkey % {len(PLANS)} AS plan_index",
        *subscription_ids("o_custkey", "o_orderkey % 2"),
        "unix_seconds(cast(o_orderdate AS timestamp)) AS at",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of both kinds; one test clock per nation."""
    buyers = read_table(spark, sf_dir, "customer").selectExpr(
        f"{padded('cus_', 'c_custkey')} AS id",
        "c_custkey AS key",
        "c_name AS name",
        "c_nationkey AS nation",
        "c_acctbal AS balance",
    )
    sellers = read_table(spark, sf_dir, "supplier").selectExpr(
        f"{padded('cus_s', 's_suppkey')} AS id",
        "s_suppkey AS key",
        "s_name AS name",
        "s_nationkey AS nation",
        "s_acctbal AS balance",
    )
    return buyers.unionByName(sellers).selectExpr(
        "id",
        """to_json(named_struct(
            'id', id,
            'object', 'customer',
            'name', name,
            'email', concat(lower(replace(name, '#', '.')), '@example.com'),
            'created', unix_seconds(timestamp '1995-01-01 00:00:00') + key,
            'delinquent', balance < 0,
            'test_clock', concat('clock_', lpad(cast(nation AS string), 2, '0')))) AS data""",
    )


STATUS = "CASE WHEN deletes THEN 'canceled' WHEN o_orderstatus = 'P' THEN 'past_due' ELSE 'active' END"


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of each subscription: the plan and outcome of its last order.

    Grouped by the numbers that its id is made of, which sort faster than texts that begin alike.
    """
    last = """max_by(struct(o_orderkey, o_orderstatus, plan_index, at, untimed),
                     struct(o_orderdate, o_orderkey)) AS last"""
    return (
        spark.sql(
            f"""SELECT o_custkey, if(o_custkey IS NULL, NULL, o_orderkey % 2) AS parity, min(at) AS start, count(*) AS n, {last}
                FROM {{orders}} GROUP BY 1, 2""",
            orders=orders(spark, sf_dir),
        )
        .selectExpr(
            *subscription_ids("o_custkey", "parity"), "start", "last.*", "n > 1 AND last.o_orderstatus = 'F' AS deletes"
        )
        .selectExpr(
            "subscription AS id",
            f"""to_json(named_struct(
                'id', subscription,
                'object', 'subscription',
                'customer', customer,
                'status', {STATUS},
                'start_date', start,
                'canceled_at', if(deletes AND NOT untimed, at, NULL),
                'cancellation_details', named_struct('reason', CASE
                    WHEN deletes AND o_orderkey % 4 = 0 THEN 'payment_failed'
                    WHEN deletes THEN 'cancellation_requested' END),
                'items', named_struct('data', array(named_struct('price', {price("plan_index")}))))) AS data""",
        )
    )


def subscription_steps(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Orders with the plan before them and whether they end their subscription."""
    return with_neighbours(
        orders(spark, sf_dir),
        key="subscription",
        order=("o_orderdate", "o_orderkey"),
        carry=("plan_index",),
        previous="before",
        following="after",
        task_rows=task_rows,
    ).selectExpr("*", "before IS NOT NULL AND after IS NULL AND o_orderstatus = 'F' AS deletes")


def events(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    event_id = padded("evt_", "o_orderkey")
    return subscription_steps(spark, sf_dir, task_rows).selectExpr(
        f"{event_id} AS id",
        f"""to_json(named_struct(
            'id', {event_id},
            'type', concat('customer.subscription.', CASE
                WHEN before IS NULL THEN 'created' WHEN deletes THEN 'deleted' ELSE 'updated' END),
            'created', at,
            'data', named_struct(
                'object', named_struct(
                    'object', 'subscription',
                    'id', subscription,
                    'customer', customer,
                    'canceled_at', if(deletes AND NOT untimed, at, NULL),
                    'items', named_struct('data', array(named_struct(
                        'price', {price("plan_index")}, 'current_period_start', at)))),
                'previous_attributes', if(before IS NULL, NULL, named_struct('items', named_struct('data', array(
                    named_struct('price', named_struct(
                        'lookup_key', get({PLAN_KEYS}, cast(before.plan_index AS int))))))))))) AS data""",
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoice_id = padded("in_", "o_orderkey")
    return spread(orders(spark, sf_dir)).selectExpr(
        f"{invoice_id} AS id",
        f"""to_json(named_struct(
            'id', {invoice_id},
            'object', 'invoice',
            'customer', customer,
            'status', CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'open'
                           WHEN o_orderkey % 3 = 0 THEN 'void' ELSE 'draft' END,
            'billing_reason', if(o_orderstatus = 'P', 'subscription_update', 'subscription_cycle'),
            'created', at,
            'amount_due', get({PLAN_CENTS}, cast(plan_index AS int)),
            'amount_paid', if(o_orderstatus = 'F', get({PLAN_CENTS}, cast(plan_index AS int)), 0),
            'attempt_count', 1 + o_orderkey % 4,
            'parent', named_struct('subscription_details', named_struct('subscription', subscription)),
            'status_transitions', named_struct('paid_at', if(o_orderstatus = 'F', at + 3600, NULL)),
            'lines', named_struct('data', array(named_struct(
                'pricing', named_struct('price_details', named_struct(
                    'price', concat('price_', cast(plan_index AS string)))),
                'period', named_struct('start', at, 'end', unix_seconds(cast(add_months(
                    cast(o_orderdate AS date), if(plan_index % 2 = 0, 1, 12)) AS timestamp)))))))) AS data""",
    )


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    charge_id = padded("ch_", "o_orderkey")
    return spread(orders(spark, sf_dir)).selectExpr(
        f"{charge_id} AS id",
        f"""to_json(named_struct(
            'id', {charge_id},
            'object', 'charge',
            'customer', customer,
            'payment_intent', {padded("pi_", "o_orderkey")},
            'status', if(o_orderstatus = 'F', 'succeeded', 'failed'),
            'amount', get({PLAN_CENTS}, cast(plan_index AS int)),
            'created', at,
            'failure_code', if(o_orderstatus = 'F', NULL, 'card_declined'))) AS data""",
    )


RAW = {
    "customers": customers,
    "subscriptions": subscriptions,
    "invoices": invoices,
    "charges": charges,
    "events": events,
}


def raw_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw tables as (id, data)."""
    return {name: build(spark, sf_dir) for name, build in RAW.items()}


def subscription_snapshots(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """What a snapshot run at the end of each period finds changed: one row per subscription with
    an event in the period, in its state after the last of them."""
    months = {"month": 1, "year": 12}[period]
    return spark.sql(
        f"""SELECT subscription AS subscription_id, customer AS customer_id,
                   cast(add_months(trunc(o_orderdate, '{period}'), {months}) AS timestamp) AS run,
                   max_by(struct({STATUS} AS status,
                                 get({PLAN_KEYS}, cast(plan_index AS int)) AS plan_key,
                                 if(deletes AND NOT untimed, cast(o_orderdate AS timestamp), NULL) AS canceled_at),
                          struct(o_orderdate, o_orderkey)) AS s
            FROM {{steps}} GROUP BY 1, 2, 3""",
        steps=subscription_steps(spark, sf_dir),
    ).selectExpr("subscription_id", "customer_id", "run", "s.*")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a feed of change events (batch, source_pos, data), one batch per day.

    Low-valued errors play deleted clocks, other errors an object type nobody loads, and low-valued
    purchases invoice previews without an id. Views carry no clock.
    """
    described = spread(read_table(spark, sf_dir, "events")).selectExpr(
        "event_id",
        "ts",
        "cast(user_id AS string) AS user",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "event_type",
    )
    kinds = described.selectExpr(
        "*",
        """CASE event_type WHEN 'view' THEN 'customer' WHEN 'signup' THEN 'subscription'
             WHEN 'purchase' THEN 'invoice' WHEN 'click' THEN 'charge'
             ELSE if(k < 5, 'test_helpers.test_clock', 'payment_intent') END AS kind""",
    )
    return kinds.selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS batch",
        "-event_id AS source_pos",
        f"""to_json(named_struct(
            'id', {padded("evt_", "event_id")},
            'type', concat(kind, if(kind = 'test_helpers.test_clock', '.deleted', '.updated')),
            'created', unix_seconds(cast(ts AS timestamp)),
            'data', named_struct('object', named_struct(
                'object', kind,
                'id', CASE kind WHEN 'test_helpers.test_clock' THEN concat('clock_', user)
                                WHEN 'invoice' THEN if(k >= 10, concat('in_', user), NULL)
                                ELSE concat(kind, '_', user) END,
                'test_clock', if(event_type IN ('view', 'error'), NULL, concat('clock_', user)),
                'k', k)))) AS data""",
    )


def write_feed_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Land the feed as JSON-array files: a sync is a day, its files hold FILE_ROWS event ids at most.

    Paths (``sync=<day>/block=<block>/...``) sort in feed order.
    """
    block = f"cast(-source_pos DIV {FILE_ROWS} AS string)"
    arrays = spark.sql(
        f"""SELECT batch AS sync, lpad({block}, greatest(9, length({block})), '0') AS block,
                   sort_array(collect_list(struct(-source_pos AS seq, data))) AS docs
            FROM {{feed}} GROUP BY 1, 2""",
        feed=change_feed(spark, sf_dir),
    ).selectExpr("sync", "block", "concat('[', array_join(transform(docs, d -> d.data), ',\\n'), ']') AS value")
    arrays.write.mode("overwrite").partitionBy("sync", "block").text(root)
