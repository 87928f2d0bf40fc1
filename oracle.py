"""DuckDB statements that recompute every query from the plain tables.

They share typed relations instead of documents, and use other constructs where there is a choice: an
interval join for month-end MRR instead of accumulated changes, the dense customer x month table instead
of change points, row numbers instead of aggregates by position.
"""

from __future__ import annotations

# The demo price list, by order key modulo its length.
PLAN_VALUES = """(0, 'solo_monthly', 1250), (1, 'solo_yearly', 13500), (2, 'team_monthly', 3700),
  (3, 'team_yearly', 40400), (4, 'fleet_monthly', 21500), (5, 'fleet_yearly', 230000)"""


def padded(number: str) -> str:
    return f"lpad({number}::VARCHAR, greatest(12, length({number}::VARCHAR))::INT, '0')"


BASE = f"""
WITH plan(k, plan_key, cents) AS (VALUES {PLAN_VALUES}),
priced AS (
  SELECT k, plan_key, 'price_' || k AS price_id, 'prod_' || split_part(plan_key, '_', 1) AS plan_name,
         CASE k % 2 WHEN 0 THEN 'month' ELSE 'year' END AS billing_interval,
         (cents / 100)::DECIMAL(12,2) AS price_amount,
         (CASE k % 2 WHEN 0 THEN cents / 100 ELSE round(cents / 1200, 2) END)::DECIMAL(12,2) AS mrr_amount
  FROM plan
),
o AS (
  SELECT o_orderkey AS ok, o_orderkey % 6 AS k, o_orderstatus AS st, o_orderdate AS d,
         o_orderpriority = '5-LOW' AS untimed, {padded("o_orderkey")} AS pad,
         'cus_' || {padded("o_custkey")} AS customer_id,
         'sub_' || {padded("o_custkey")} || '_' || (o_orderkey % 2) AS subscription_id
  FROM orders
),
steps AS (
  SELECT *, nth > 1 AND nth = n AND st = 'F' AS deletes FROM (
    SELECT *, lag(k) OVER w AS before_k, row_number() OVER w AS nth,
           count(*) OVER (PARTITION BY subscription_id) AS n,
           min(d) OVER (PARTITION BY subscription_id) AS first_d
    FROM o WINDOW w AS (PARTITION BY subscription_id ORDER BY d, ok))
),
stepped AS (
  SELECT s.*, p.plan_key, p.price_id, p.plan_name, p.billing_interval, p.price_amount,
         CASE WHEN deletes THEN 'canceled' WHEN st = 'P' THEN 'past_due' ELSE 'active' END AS status,
         CASE WHEN deletes AND NOT untimed THEN d END AS canceled_at
  FROM steps s JOIN priced p USING (k)
),
stg_customers AS (
  SELECT 'cus_' || {padded("c_custkey")} AS customer_id, c_name AS customer_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         TIMESTAMP '1995-01-01' + to_seconds(c_custkey) AS created_at, c_acctbal < 0 AS is_delinquent,
         c_nationkey AS nation
  FROM customer
  UNION ALL
  SELECT 'cus_s' || {padded("s_suppkey")}, s_name, lower(replace(s_name, '#', '.')) || '@example.com',
         TIMESTAMP '1995-01-01' + to_seconds(s_suppkey), s_acctbal < 0, s_nationkey
  FROM supplier
),
stg_subscriptions AS (
  SELECT subscription_id, customer_id, status, price_id, plan_key, plan_name, billing_interval, price_amount,
         first_d AS started_at, canceled_at,
         CASE WHEN deletes THEN CASE ok % 4 WHEN 0 THEN 'payment_failed' ELSE 'cancellation_requested' END END
           AS cancellation_reason
  FROM stepped WHERE nth = n
),
stg_invoices AS (
  SELECT 'in_' || pad AS invoice_id, customer_id, subscription_id, 'price_' || k AS price_id,
         CASE st WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE CASE ok % 3 WHEN 0 THEN 'void' ELSE 'draft' END END
           AS status,
         CASE st WHEN 'P' THEN 'subscription_update' ELSE 'subscription_cycle' END AS billing_reason,
         d AS created_at, d AS period_start,
         CASE k % 2 WHEN 0 THEN d + INTERVAL 1 MONTH ELSE d + INTERVAL 12 MONTH END AS period_end,
         CASE st WHEN 'F' THEN d + INTERVAL 1 HOUR END AS paid_at, price_amount AS amount_due,
         CASE st WHEN 'F' THEN price_amount ELSE 0 END AS amount_paid, (1 + ok % 4)::BIGINT AS attempt_count
  FROM o JOIN priced USING (k)
),
stg_charges AS (
  SELECT 'ch_' || pad AS charge_id, customer_id, 'pi_' || pad AS payment_intent_id,
         CASE st WHEN 'F' THEN 'succeeded' ELSE 'failed' END AS status, price_amount AS amount, d AS created_at,
         CASE st WHEN 'F' THEN NULL ELSE 'card_declined' END AS failure_code
  FROM o JOIN priced USING (k)
),
stg_subscription_events AS (
  SELECT 'evt_' || pad AS event_id,
         'customer.subscription.' || CASE WHEN nth = 1 THEN 'created' WHEN deletes THEN 'deleted' ELSE 'updated' END
           AS event_type,
         subscription_id, customer_id, q.plan_key AS previous_plan_key, s.plan_key, d AS period_start, canceled_at
  FROM stepped s LEFT JOIN plan q ON q.k = s.before_k
),
dim_plan AS (
  SELECT price_id, plan_key, plan_name, billing_interval, price_amount, mrr_amount FROM priced
  WHERE plan_key IN (SELECT plan_key FROM stg_subscriptions)
),
fct_invoices AS (
  SELECT i.*, p.plan_key, p.plan_name, p.billing_interval, i.status = 'paid' AS is_paid,
         date_trunc('month', period_start)::DATE AS invoice_month, amount_due - amount_paid AS amount_unpaid
  FROM stg_invoices i LEFT JOIN dim_plan p USING (price_id)
),
sub_rollup AS (
  SELECT customer_id, min(started_at) AS first_subscribed_at,
         arg_max(plan_key, (started_at, subscription_id)) AS current_plan_key,
         arg_max(status, (started_at, subscription_id)) AS subscription_status, max(canceled_at) AS canceled_at,
         arg_max(cancellation_reason, (started_at, subscription_id)) AS cancellation_reason
  FROM stg_subscriptions GROUP BY ALL
),
inv_rollup AS (
  SELECT customer_id, sum(amount_paid) AS lifetime_revenue, count(*) AS invoice_count,
         sum((NOT is_paid)::INT)::BIGINT AS unpaid_invoice_count
  FROM fct_invoices GROUP BY ALL
),
dim_customer AS (
  SELECT c.customer_id, customer_name, email, created_at,
         date_trunc('month', first_subscribed_at)::DATE AS cohort_month, current_plan_key, subscription_status,
         canceled_at, cancellation_reason, ifnull(lifetime_revenue, 0) AS lifetime_revenue,
         ifnull(invoice_count, 0) AS invoice_count, ifnull(unpaid_invoice_count, 0) AS unpaid_invoice_count
  FROM stg_customers c LEFT JOIN sub_rollup s ON c.customer_id = s.customer_id
       LEFT JOIN inv_rollup i ON c.customer_id = i.customer_id
),
fct_events AS (
  SELECT event_id, subscription_id, customer_id, kind AS event_type,
         CASE kind WHEN 'canceled' THEN canceled_at ELSE period_start END AS occurred_at,
         plan_key, previous_plan_key,
         CASE kind WHEN 'canceled' THEN m1 ELSE ifnull(m0, 0) END AS mrr_before,
         CASE kind WHEN 'canceled' THEN 0 ELSE m1 END AS mrr_after
  FROM (
    SELECT e.*, b.mrr_amount AS m1, a.mrr_amount AS m0,
           CASE split_part(event_type, '.', 3) WHEN 'created' THEN 'started' WHEN 'deleted' THEN 'canceled'
                ELSE CASE sign(b.mrr_amount - a.mrr_amount) WHEN 1 THEN 'upgraded' WHEN -1 THEN 'downgraded' END
           END AS kind
    FROM stg_subscription_events e LEFT JOIN dim_plan b ON b.plan_key = e.plan_key
         LEFT JOIN dim_plan a ON a.plan_key = e.previous_plan_key
    WHERE e.subscription_id IN (SELECT subscription_id FROM stg_subscriptions))
  WHERE kind IS NOT NULL
),
timed AS (
  SELECT * FROM fct_events WHERE occurred_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY subscription_id, occurred_at ORDER BY event_id DESC) = 1
),
months AS (
  SELECT unnest(range(date_trunc('month', lo), hi + INTERVAL 1 SECOND, INTERVAL 1 MONTH))::DATE AS month
  FROM (SELECT min(occurred_at) AS lo, max(occurred_at) AS hi FROM timed)
),
ends AS (
  SELECT s.subscription_id, m.month, (m.month + INTERVAL 1 MONTH)::TIMESTAMP AS until
  FROM (SELECT DISTINCT subscription_id FROM timed) s, months m
),
sub_months AS (
  SELECT ends.month, t.customer_id, t.mrr_after AS mrr
  FROM ends JOIN (
    SELECT *, lead(occurred_at, 1, TIMESTAMP '9999-01-01') OVER (PARTITION BY subscription_id ORDER BY occurred_at)
                AS next_at FROM timed) t
    ON ends.subscription_id = t.subscription_id AND ends.until > t.occurred_at AND ends.until <= t.next_at
),
dense AS (
  SELECT c.customer_id, m.month, ifnull(x.mrr, 0)::DECIMAL(22,2) AS mrr
  FROM stg_customers c CROSS JOIN months m
  LEFT JOIN (SELECT customer_id, month, sum(mrr) AS mrr FROM sub_months GROUP BY ALL) x
    ON x.customer_id = c.customer_id AND x.month = m.month
),
mcm AS (
  SELECT customer_id, month, mrr, prev AS previous_mrr, mrr - prev AS mrr_change,
         CASE WHEN mrr = prev THEN NULL
              WHEN mrr = 0 THEN 'churn'
              WHEN prev = 0 THEN CASE WHEN paid_before > 0 THEN 'reactivation' ELSE 'new' END
              WHEN mrr > prev THEN 'expansion' ELSE 'contraction' END AS movement
  FROM (
    SELECT *, lag(mrr, 1, 0) OVER w AS prev,
           ifnull(sum((mrr > 0)::INT) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS paid_before
    FROM dense WINDOW w AS (PARTITION BY customer_id ORDER BY month))
),
mm AS (
  SELECT month, sum(mrr) AS mrr, sum((mrr > 0)::INT)::BIGINT AS active_customers,
         sum(CASE movement WHEN 'new' THEN mrr_change ELSE 0 END) AS new_mrr,
         sum(CASE movement WHEN 'expansion' THEN mrr_change ELSE 0 END) AS expansion_mrr,
         sum(CASE movement WHEN 'reactivation' THEN mrr_change ELSE 0 END) AS reactivation_mrr,
         sum(CASE movement WHEN 'contraction' THEN mrr_change ELSE 0 END) AS contraction_mrr,
         sum(CASE movement WHEN 'churn' THEN mrr_change ELSE 0 END) AS churn_mrr,
         sum(CASE movement WHEN 'new' THEN 1 ELSE 0 END)::BIGINT AS new_customers,
         sum(CASE movement WHEN 'churn' THEN 1 ELSE 0 END)::BIGINT AS churned_customers
  FROM mcm GROUP BY month
),
plan_counts AS (
  SELECT current_plan_key AS plan, count(CASE WHEN subscription_status = 'active' THEN 1 END) AS active,
         count(CASE WHEN subscription_status = 'canceled' THEN 1 END) AS canceled,
         count(CASE WHEN cancellation_reason = 'cancellation_requested' THEN 1 END) AS cancellation_requested,
         count(CASE WHEN cancellation_reason = 'payment_failed' THEN 1 END) AS payment_failed
  FROM dim_customer GROUP BY ALL
),
cohort_cells AS (
  SELECT strftime(cohort_month, '%Y-%m') AS cohort, date_diff('month', cohort_month, month) AS months_since,
         avg((mrr > 0)::INT) AS share
  FROM mcm JOIN dim_customer USING (customer_id) WHERE month >= cohort_month GROUP BY ALL
),
month_states AS (
  SELECT *, (date_trunc('month', d) + INTERVAL 1 MONTH)::TIMESTAMP AS run FROM stepped
  QUALIFY row_number() OVER (PARTITION BY subscription_id, date_trunc('month', d) ORDER BY d DESC, ok DESC) = 1
),
year_states AS (
  SELECT *, (date_trunc('year', d) + INTERVAL 1 YEAR)::TIMESTAMP AS run FROM stepped
  QUALIFY row_number() OVER (PARTITION BY subscription_id, date_trunc('year', d) ORDER BY d DESC, ok DESC) = 1
),
month_history AS (
  SELECT subscription_id, customer_id, status, plan_key, canceled_at, run AS valid_from,
         lead(run) OVER (PARTITION BY subscription_id ORDER BY run) AS valid_to
  FROM (SELECT * FROM month_states WINDOW w AS (PARTITION BY subscription_id ORDER BY run)
        QUALIFY lag(run) OVER w IS NULL OR lag(status) OVER w IS DISTINCT FROM status
          OR lag(plan_key) OVER w IS DISTINCT FROM plan_key OR lag(canceled_at) OVER w IS DISTINCT FROM canceled_at)
),
year_history AS (
  SELECT subscription_id, customer_id, status, plan_key, canceled_at, run AS valid_from,
         lead(run) OVER (PARTITION BY subscription_id ORDER BY run) AS valid_to
  FROM (SELECT * FROM year_states WINDOW w AS (PARTITION BY subscription_id ORDER BY run)
        QUALIFY lag(run) OVER w IS NULL OR lag(status) OVER w IS DISTINCT FROM status
          OR lag(plan_key) OVER w IS DISTINCT FROM plan_key OR lag(canceled_at) OVER w IS DISTINCT FROM canceled_at)
),
sub_history AS (
  SELECT h.subscription_id, h.customer_id, h.status, h.plan_key, p.plan_name, p.billing_interval, p.mrr_amount,
         h.valid_from, h.valid_to, h.valid_to IS NULL AS is_current
  FROM month_history h LEFT JOIN dim_plan p USING (plan_key)
),
f0 AS (
  SELECT event_id AS n, event_type AS et, (props ->> '$.k')::INT AS k, user_id::VARCHAR AS u,
         strftime(ts, '%Y-%m-%d') AS batch, epoch_us(ts) // 1000000 AS created
  FROM events
),
f1 AS (
  SELECT *, CASE et WHEN 'view' THEN 'customer' WHEN 'signup' THEN 'subscription' WHEN 'purchase' THEN 'invoice'
                    WHEN 'click' THEN 'charge'
                    ELSE CASE WHEN k < 5 THEN 'test_helpers.test_clock' ELSE 'payment_intent' END END AS kind
  FROM f0
),
feed AS (
  SELECT n, k, batch, created, kind, 'evt_' || {padded("n")} AS event_id,
         CASE kind WHEN 'test_helpers.test_clock' THEN kind || '.deleted' ELSE kind || '.updated' END AS event_type,
         CASE kind WHEN 'test_helpers.test_clock' THEN 'clock_' || u
                   WHEN 'invoice' THEN CASE WHEN k >= 10 THEN 'in_' || u END
                   ELSE kind || '_' || u END AS object_id,
         CASE WHEN et NOT IN ('view', 'error') THEN 'clock_' || u END AS test_clock,
         CASE kind WHEN 'customer' THEN 'customers' WHEN 'subscription' THEN 'subscriptions'
                   WHEN 'invoice' THEN 'invoices' WHEN 'charge' THEN 'charges' END AS type
  FROM f1
),
kept AS (
  SELECT * FROM feed f WHERE NOT EXISTS (
    SELECT 1 FROM feed x WHERE x.kind = 'test_helpers.test_clock' AND x.batch = f.batch AND x.object_id = f.test_clock)
),
chosen AS (
  SELECT customer_id FROM stg_customers
  WHERE nation IN (SELECT DISTINCT nation FROM stg_customers ORDER BY lpad(nation::VARCHAR, 2, '0') LIMIT 2)
)
"""


def _ts(*names: str) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n.split('.')[-1]}" for n in names)


def _day(*names: str) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d') AS {n.split('.')[-1]}" for n in names)


def _money(*names: str) -> str:
    return ", ".join(f"{n}::DOUBLE AS {n.split('.')[-1]}" for n in names)


WATERFALL = ("new_mrr", "expansion_mrr", "reactivation_mrr", "contraction_mrr", "churn_mrr")
SERIES = (
    f"{_day('month')}, {_money('mrr', *WATERFALL)}, active_customers, new_customers, churned_customers"
)
HISTORY = f"subscription_id, customer_id, status, plan_key, {_ts('canceled_at', 'valid_from', 'valid_to')}"

KEYS = [
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
RELATION = {
    "fct_subscription_events": "fct_events",
    "mrr_monthly": "mm",
    "mrr_customer_monthly": "mcm",
    "dim_subscription_history": "sub_history",
}


def _rules(rule: str, checks: list[tuple[str, str | None, str]]) -> str:
    """(table, column, scalar SQL for the number of failures) to one row per rule."""
    rows = [
        f"SELECT '{rule}' AS rule, '{t}' AS table_name, {f"'{c}'" if c else 'NULL::VARCHAR'} AS column_name, "
        f"({sql})::BIGINT AS n_failed"
        for t, c, sql in checks
    ]
    return "SELECT *, n_failed = 0 AS passed FROM (" + " UNION ALL ".join(rows) + ")"


def _duplicates(table: str, column: str) -> str:
    relation = RELATION.get(table, table)
    return f"SELECT count(*) FROM (SELECT {column} FROM {relation} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


def _where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {RELATION.get(table, table)} WHERE {condition}"


def _one_of(column: str, *values: str) -> str:
    return f"{column} NOT IN ({', '.join(repr(v) for v in values)})"


def statements() -> dict[str, str]:
    not_null = KEYS + [
        ("stg_subscriptions", "customer_id"),
        ("dim_subscription_history", "subscription_id"),
        ("dim_subscription_history", "valid_from"),
        ("dim_customer", "cohort_month"),
        ("stg_invoices", "paid_at"),
    ]
    bodies = {
        # ingest
        "raw_scan": "SELECT batch AS sync, n // 20000 AS block, row_number() OVER (PARTITION BY batch, n // 20000 ORDER BY n) - 1 "
        "AS pos, event_id AS id, k::BIGINT AS k FROM feed",
        "latest_snapshot": "SELECT type, object_id AS id, arg_max(k, n)::BIGINT AS k FROM feed "
        "WHERE type IS NOT NULL AND object_id IS NOT NULL GROUP BY ALL",
        "upsert_raw": "SELECT object_id AS id, arg_max(k, n)::BIGINT AS k, CASE WHEN max(batch) >= '2024-01-16' "
        "THEN '2024-01-31 00:00:00' ELSE '2024-01-16 00:00:00' END AS loaded_at FROM feed "
        "WHERE type IS NOT NULL AND object_id IS NOT NULL GROUP BY object_id",
        "load_all_counts": "SELECT 'customers' AS type, count(*) AS n_rows FROM stg_customers "
        "UNION ALL SELECT 'subscriptions', count(DISTINCT subscription_id) FROM o "
        "UNION ALL SELECT unnest(['invoices', 'charges', 'events']), count(*) FROM o",
        "landing_roundtrip": "SELECT '2031-04-17T08-09-10Z' AS sync, 'ch_' || pad AS id, cents::BIGINT AS amount, "
        "CASE WHEN st <> 'F' THEN 'card_declined' END AS failure_code FROM o JOIN plan USING (k)",
        "incremental_events": "SELECT event_id, event_type, created, n AS seq FROM feed WHERE created >= 1705276800",
        "next_cursor": "SELECT ifnull(max(created), 1705276800) AS cursor FROM kept WHERE created >= 1705276800",
        "dead_clock_suppression": "SELECT batch, event_id, event_type, test_clock FROM kept",
        "route_snapshots": "SELECT type, object_id AS id, batch, created, k::BIGINT AS k FROM feed "
        "WHERE type IS NOT NULL AND object_id IS NOT NULL",
        "stream_upsert": "SELECT type, object_id AS id, arg_max(k, n)::BIGINT AS k FROM kept "
        "WHERE type IS NOT NULL AND object_id IS NOT NULL GROUP BY ALL "
        "UNION ALL SELECT 'events', event_id, k::BIGINT FROM kept",
        # One sync reads all that came since the first one's start; a clock deleted in it takes its events along.
        "sync_state": "SELECT max(created) AS cursor, '2024-02-01T00-00-00Z' AS last_sync FROM feed f WHERE created >= 1705708800 "
        "AND NOT EXISTS (SELECT 1 FROM feed x WHERE x.created >= 1705708800 AND x.kind = 'test_helpers.test_clock' "
        "AND x.object_id = f.test_clock)",
        "sample_by_parent": "SELECT 'customers' AS type, customer_id AS id FROM chosen "
        "UNION ALL SELECT 'subscriptions', subscription_id FROM stg_subscriptions JOIN chosen USING (customer_id) "
        "UNION ALL SELECT 'invoices', invoice_id FROM stg_invoices JOIN chosen USING (customer_id) "
        "UNION ALL SELECT 'charges', charge_id FROM stg_charges JOIN chosen USING (customer_id) "
        "UNION ALL SELECT 'events', event_id FROM stg_subscription_events JOIN chosen USING (customer_id)",
        # staging
        "stg_customers": f"SELECT customer_id, customer_name, email, {_ts('created_at')}, is_delinquent FROM stg_customers",
        "stg_subscriptions": "SELECT subscription_id, customer_id, status, price_id, plan_key, plan_name, billing_interval, "
        f"{_money('price_amount')}, {_ts('started_at', 'canceled_at')}, cancellation_reason FROM stg_subscriptions",
        "stg_invoices": "SELECT invoice_id, customer_id, subscription_id, price_id, status, billing_reason, "
        f"{_ts('created_at', 'period_start', 'period_end', 'paid_at')}, {_money('amount_due', 'amount_paid')}, "
        "attempt_count FROM stg_invoices",
        "stg_charges": f"SELECT charge_id, customer_id, payment_intent_id, status, {_money('amount')}, "
        f"{_ts('created_at')}, failure_code FROM stg_charges",
        "stg_subscription_events": "SELECT event_id, event_type, subscription_id, customer_id, previous_plan_key, plan_key, "
        f"{_ts('period_start', 'canceled_at')} FROM stg_subscription_events",
        # marts
        "dim_plan": "SELECT price_id, plan_key, plan_name, billing_interval, "
        f"{_money('price_amount', 'mrr_amount')} FROM dim_plan",
        "customer_subscription_rollup": f"SELECT customer_id, {_ts('first_subscribed_at', 'canceled_at')}, "
        "current_plan_key, subscription_status, cancellation_reason FROM sub_rollup",
        "customer_invoice_rollup": f"SELECT customer_id, {_money('lifetime_revenue')}, invoice_count, unpaid_invoice_count "
        "FROM inv_rollup",
        "dim_customer": f"SELECT customer_id, customer_name, email, {_ts('created_at', 'canceled_at')}, {_day('cohort_month')}, "
        f"current_plan_key, subscription_status, cancellation_reason, {_money('lifetime_revenue')}, invoice_count, "
        "unpaid_invoice_count FROM dim_customer",
        "fct_invoices": "SELECT invoice_id, customer_id, subscription_id, plan_key, plan_name, billing_interval, billing_reason, "
        f"status, is_paid, {_ts('created_at', 'period_start', 'period_end', 'paid_at')}, {_day('invoice_month')}, "
        f"{_money('amount_due', 'amount_paid', 'amount_unpaid')}, attempt_count FROM fct_invoices",
        "fct_subscription_events": "SELECT event_id, subscription_id, customer_id, event_type, plan_key, previous_plan_key, "
        f"{_ts('occurred_at')}, {_money('mrr_before', 'mrr_after')} FROM fct_events",
        "plan_prices": "SELECT plan_key, mrr_amount::DOUBLE AS mrr_amount, NULL::VARCHAR AS valid_from, NULL::VARCHAR AS valid_to FROM priced "
        "WHERE k IN (SELECT k FROM o)",
        "fct_subscription_events_own_prices": f"SELECT event_id, subscription_id, customer_id, event_type, {_ts('occurred_at')}, plan_key, "
        f"previous_plan_key, {_money('mrr_before', 'mrr_after')} FROM fct_events",
        "mrr_segments": f"SELECT customer_id, subscription_id, event_id, {_ts('valid_from', 'valid_to')}, mrr::DOUBLE AS mrr FROM "
        "(SELECT *, occurred_at AS valid_from, mrr_after AS mrr, lead(occurred_at) OVER (PARTITION BY subscription_id "
        "ORDER BY occurred_at NULLS LAST, event_id) AS valid_to FROM fct_events)",
        "month_spine": f"SELECT strftime(month, '%Y-%m-%d') AS month_start FROM months",
        "customer_month_grid": "SELECT customer_id, strftime(month, '%Y-%m-%d') AS month_start, "
        "strftime(month + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month_start FROM stg_customers, months",
        "month_end_mrr": "SELECT customer_id, strftime(month, '%Y-%m-%d') AS month_start, mrr::DOUBLE AS mrr FROM dense",
        "month_end_mrr_join": "SELECT customer_id, strftime(month, '%Y-%m-%d') AS month_start, mrr::DOUBLE AS mrr FROM dense",
        "mrr_customer_monthly": f"SELECT customer_id, {_day('month')}, {_money('mrr', 'previous_mrr', 'mrr_change')}, "
        "movement FROM mcm",
        "mrr_monthly": f"SELECT {SERIES} FROM mm",
        "mrr_monthly_refresh": f"SELECT {SERIES} FROM mm",
        "mrr_customer_monthly_refresh": f"SELECT customer_id, {_day('month')}, {_money('mrr', 'previous_mrr', 'mrr_change')}, "
        "movement FROM mcm",
        "scd2_incremental": f"SELECT {HISTORY} FROM year_history",
        "history_stream": f"SELECT {HISTORY} FROM month_history",
        "scd2_rebuild": f"SELECT {HISTORY} FROM month_history",
        "dim_subscription_history": "SELECT subscription_id, customer_id, status, plan_key, plan_name, billing_interval, "
        f"{_money('mrr_amount')}, {_ts('valid_from', 'valid_to')}, is_current FROM sub_history",
        "history_as_of": f"SELECT subscription_id, customer_id, status, plan_key, {_money('mrr_amount')}, "
        f"{_ts('valid_from', 'valid_to')} FROM sub_history WHERE valid_from <= TIMESTAMP '1998-03-15' "
        "AND ifnull(valid_to, TIMESTAMP '9999-01-01') > TIMESTAMP '1998-03-15'",
        "history_as_of_many": f"SELECT a.subscription_id, {_ts('a.at')}, h.status, h.plan_key, h.mrr_amount::DOUBLE AS mrr_amount, "
        f"{_ts('h.valid_from', 'h.valid_to')} FROM (SELECT subscription_id, d AS at FROM o UNION SELECT subscription_id, run FROM month_states) a "
        "LEFT JOIN sub_history h ON h.subscription_id = a.subscription_id AND h.valid_from <= a.at "
        "AND (h.valid_to IS NULL OR a.at < h.valid_to)",
        # dashboard
        "export_mrr_series": f"SELECT {SERIES} FROM mm",
        "export_plans": "SELECT * FROM plan_counts",
        "export_cohorts": "SELECT cohort, months_since, round(share, 2) AS retained FROM cohort_cells",
        "export_unpaid": "SELECT ifnull(sum(CASE WHEN is_paid THEN 0 ELSE amount_unpaid END), 0)::DOUBLE AS unpaid_amount "
        "FROM fct_invoices",
        "kpi_latest": f"SELECT {_day('now.month')}, now.mrr::DOUBLE AS mrr, (now.mrr - old.mrr)::DOUBLE AS mrr_delta, "
        "CASE WHEN now.mrr >= old.mrr THEN 'up' WHEN now.mrr < old.mrr THEN 'down' END AS direction, now.active_customers, "
        "now.new_customers, now.churned_customers, now.churned_customers / old.active_customers AS churn_rate, "
        "(SELECT sum(amount_unpaid) FROM fct_invoices WHERE NOT is_paid)::DOUBLE AS unpaid_amount "
        "FROM mm now LEFT JOIN mm old ON old.month = now.month - INTERVAL 1 MONTH "
        "WHERE now.month = (SELECT max(month) FROM mm)",
        "plan_churn_table": "SELECT plan, active, canceled, active + canceled AS total, "
        "CASE WHEN active + canceled > 0 THEN canceled / (active + canceled) * 100 END AS churn_pct FROM plan_counts",
        "cohort_matrix": "SELECT c.cohort, m.months_since, round(x.share, 2) AS retained "
        "FROM (SELECT DISTINCT cohort FROM cohort_cells) c CROSS JOIN "
        "(SELECT unnest(range(0, 1 + max(months_since))) AS months_since FROM cohort_cells) m "
        "LEFT JOIN cohort_cells x ON x.cohort = c.cohort AND x.months_since = m.months_since",
        "dashboard_payload": " UNION ALL ".join(
            [
                f"SELECT 'mrr_monthly' AS section, row_number() OVER (ORDER BY month) - 1 AS n, strftime(month, '%Y-%m-%d') AS item, "
                f"NULL::BIGINT AS months_since, '{m}' AS measure, {m}::DOUBLE AS value FROM mm"
                for m in ("mrr", "active_customers", *WATERFALL, "new_customers", "churned_customers")
            ]
            + [
                f"SELECT 'plans', row_number() OVER (ORDER BY plan NULLS LAST) - 1, plan, NULL, '{m}', {m}::DOUBLE FROM plan_counts"
                for m in ("active", "canceled", "cancellation_requested", "payment_failed")
            ]
            + [
                "SELECT 'cohorts', row_number() OVER (ORDER BY cohort, months_since) - 1, cohort, months_since, 'retained', "
                "round(share, 2) FROM cohort_cells",
                "SELECT 'unpaid', 0, NULL, NULL, 'unpaid_amount', ifnull(sum(CASE WHEN is_paid THEN 0 ELSE amount_unpaid END), 0)"
                "::DOUBLE FROM fct_invoices",
            ]
        ),
        # analyses
        "waterfall_long": " UNION ALL ".join(
            f"SELECT {_day('month')}, '{m}' AS movement, {m}::DOUBLE AS amount FROM mm" for m in WATERFALL
        ),
        "monthly_churn_rate": f"SELECT {_day('now.month')}, now.churned_customers / old.active_customers AS churn_rate "
        "FROM mm now LEFT JOIN mm old ON old.month = now.month - INTERVAL 1 MONTH",
        "plan_status_crosstab": "SELECT c.current_plan_key, c.subscription_status, count(*) AS customers, "
        "round_even((SELECT avg((x.subscription_status = 'canceled')::INT) FROM dim_customer x "
        "WHERE x.current_plan_key = c.current_plan_key AND x.subscription_status IS NOT NULL) * 1000, 0) / 10 AS churn_pct "
        "FROM dim_customer c WHERE c.current_plan_key IS NOT NULL AND c.subscription_status IS NOT NULL GROUP BY ALL",
        "plan_reason_crosstab": "SELECT current_plan_key, cancellation_reason, count(*) AS customers FROM dim_customer "
        "WHERE current_plan_key IS NOT NULL AND cancellation_reason IS NOT NULL GROUP BY ALL",
        "cohort_pivot": "SELECT cohort, "
        + ", ".join(f"max(CASE months_since WHEN {m} THEN share END) AS m{m}" for m in range(80))
        + " FROM cohort_cells GROUP BY cohort",
        "customer_months_by_plan": "SELECT current_plan_key, count(*) AS customer_months FROM mcm "
        "JOIN dim_customer USING (customer_id) WHERE mrr > 0 AND current_plan_key IS NOT NULL GROUP BY 1",
        "cancellations_by_plan": "SELECT plan_key, sum((event_type = 'canceled')::INT)::BIGINT AS cancellations FROM fct_events "
        "GROUP BY 1 HAVING cancellations > 0 AND plan_key IS NOT NULL",
        "ltv_by_plan": "SELECT plan_key, plan_name, billing_interval, mrr_amount::DOUBLE AS mrr_amount, customer_months, "
        "cancellations, realized_revenue_per_customer, cancellations = 0 AS is_infinite, "
        "CASE WHEN customer_months > 0 THEN cancellations / customer_months * 100 END AS monthly_churn_pct, "
        "CASE WHEN cancellations > 0 THEN 100 / (cancellations / customer_months * 100) END AS expected_lifetime_months, "
        "CASE WHEN cancellations > 0 THEN mrr_amount::DOUBLE * (100 / (cancellations / customer_months * 100)) END AS expected_ltv "
        "FROM (SELECT p.plan_key, plan_name, billing_interval, mrr_amount, "
        "(SELECT count(*) FROM mcm JOIN dim_customer c USING (customer_id) WHERE mrr > 0 AND c.current_plan_key = p.plan_key) "
        "AS customer_months, "
        "(SELECT count(*) FROM fct_events e WHERE e.event_type = 'canceled' AND e.plan_key = p.plan_key) AS cancellations, "
        "(SELECT sum(lifetime_revenue)::DOUBLE / count(*) FROM dim_customer c WHERE c.current_plan_key = p.plan_key) "
        "AS realized_revenue_per_customer FROM dim_plan p)",
        "charges_by_status": "SELECT status, count(*) AS charges, sum(amount)::DOUBLE AS amount FROM stg_charges GROUP BY ALL",
        "unpaid_summary": "SELECT sum((NOT is_paid)::INT)::BIGINT AS unpaid_invoices, "
        "sum(CASE WHEN is_paid THEN 0 ELSE amount_unpaid END)::DOUBLE AS unpaid_amount FROM fct_invoices",
        "involuntary_churn": "SELECT (SELECT count(*) FROM lost) AS lost_customers, mrr::DOUBLE AS lost_mrr, "
        "(mrr * 12)::DOUBLE AS lost_mrr_annualised FROM (SELECT ifnull(sum(mrr_before), 0) AS mrr FROM fct_events "
        "WHERE event_type = 'canceled' AND customer_id IN (FROM lost))",
        "unpaid_by_plan": "SELECT plan_name, sum(amount_unpaid)::DOUBLE AS amount_unpaid FROM fct_invoices "
        "WHERE NOT is_paid AND plan_name IS NOT NULL GROUP BY ALL",
        # quality
        "dq_unique": _rules("unique", [(t, c, _duplicates(t, c)) for t, c in [*KEYS, ("lineitem", "l_orderkey")]]),
        "dq_not_null": _rules("not_null", [(t, c, _where(t, f"{c} IS NULL")) for t, c in not_null]),
        "dq_accepted_values": _rules(
            "accepted_values",
            [
                (t, c, _where(t, _one_of(c, *values)))
                for t, c, values in [
                    (
                        "stg_subscriptions",
                        "status",
                        ("active", "past_due", "canceled", "unpaid", "trialing", "incomplete"),
                    ),
                    ("stg_invoices", "status", ("draft", "open", "paid", "void", "uncollectible")),
                    ("fct_subscription_events", "event_type", ("started", "upgraded", "downgraded", "canceled")),
                    (
                        "mrr_customer_monthly",
                        "movement",
                        ("new", "expansion", "contraction", "churn", "reactivation"),
                    ),
                    ("stg_invoices", "billing_reason", ("subscription_cycle",)),
                ]
            ],
        ),
        "dq_relationships": _rules(
            "relationships",
            [
                ("fct_invoices", "customer_id", _where("fct_invoices", "customer_id NOT IN (SELECT customer_id FROM dim_customer)")),
                (
                    "fct_invoices",
                    "subscription_id",
                    _where(
                        "fct_invoices",
                        "subscription_id NOT IN (SELECT subscription_id FROM stg_subscriptions WHERE status = 'canceled')",
                    ),
                ),
            ],
        ),
        "dq_row_count": _rules(
            "row_count_between",
            [
                ("dim_customer", None, "SELECT (count(*) < 1)::INT FROM dim_customer"),
                ("mrr_monthly", None, "SELECT (count(*) < 1)::INT FROM months"),
                ("mrr_monthly", None, "SELECT (count(*) NOT BETWEEN 12 AND 60)::INT FROM months"),
            ],
        ),
        "dq_values_between": _rules(
            "values_between",
            [
                ("mrr_monthly", "mrr", _where("mrr_monthly", "mrr < 0")),
                ("mrr_monthly", "active_customers", _where("mrr_monthly", "active_customers < 0")),
                ("mrr_monthly", "churn_mrr", _where("mrr_monthly", "churn_mrr > 0")),
                ("mrr_monthly", "mrr", _where("mrr_monthly", "NOT mrr BETWEEN 0 AND 50000")),
            ],
        ),
        "dq_one_current_row": _rules(
            "one_current_row",
            [
                (
                    "dim_subscription_history",
                    "subscription_id",
                    "SELECT count(*) FROM (SELECT subscription_id FROM sub_history WHERE valid_to IS NULL "
                    "GROUP BY ALL HAVING count(*) <> 1)",
                )
            ],
        ),
        "dq_freshness": "SELECT table_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS loaded_at, "
        "CASE WHEN TIMESTAMP '2024-02-02' - t > INTERVAL 7 DAY THEN 'error' "
        "WHEN TIMESTAMP '2024-02-02' - t > INTERVAL 2 DAY THEN 'warn' ELSE 'pass' END AS status FROM ("
        "SELECT 'events' AS table_name, max(ts) AS t FROM events UNION ALL SELECT 'orders', max(o_orderdate) FROM orders "
        "UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)",
        "dq_dashboard": "SELECT count(*) AS months, arg_max(mrr, month)::DOUBLE AS latest_mrr, "
        "count(*) >= 12 AND arg_max(mrr, month) > 0 AS passed FROM mm",
    }
    lost = ", lost AS (SELECT customer_id FROM dim_customer WHERE cancellation_reason = 'payment_failed')"
    return {name: BASE + (lost if "lost" in body else "") + body for name, body in bodies.items()}
