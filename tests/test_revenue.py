"""Edge cases of staging, lifecycle events and monthly revenue on hand-made rows."""

import json
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subtally.functions.numeric import finite, ratio, round_half_even, round_scaled
from subtally.plans import analyses, dashboard, marts, revenue, staging

EVENT = "event_id string, event_type string, subscription_id string, customer_id string, previous_plan_key string, plan_key string, period_start timestamp, canceled_at timestamp"
SUB = "subscription_id string, customer_id string, status string, price_id string, plan_key string, plan_name string, billing_interval string, price_amount decimal(12,2), started_at timestamp, canceled_at timestamp, cancellation_reason string"
FACT = "event_id string, subscription_id string, customer_id string, event_type string, occurred_at timestamp, plan_key string, mrr_before decimal(12,2), mrr_after decimal(12,2)"
CREATED, UPDATED, DELETED = (f"customer.subscription.{k}" for k in ("created", "updated", "deleted"))


def raw(spark, *docs):
    return spark.createDataFrame([(d["id"], json.dumps(d)) for d in docs], "id string, data string")


def subscription(i, customer, plan="basic", price=10, start=datetime(2026, 1, 1), reason=None, status="active"):
    return (i, customer, status, f"price_{plan}", plan, f"prod_{plan}", "month", Decimal(price), start, None, reason)


def test_staging_tolerates_empty_arrays_and_quoted_numbers(spark):
    row = staging.stg_subscriptions(
        raw(spark, {"id": "sub_1", "items": {"data": []}, "start_date": "1754006400", "extra": [1]})
    ).first()
    assert (row.price_id, row.price_amount, row.canceled_at) == (None, None, None)
    assert row.started_at == datetime(2025, 8, 1)


def test_staging_raises_on_bad_numbers(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_charges(raw(spark, {"id": "ch_1", "amount": "ten"})).collect()


def test_event_staging_keeps_subscription_events_only(spark):
    docs = [
        {"id": "evt_1", "type": "customer.subscription.updated", "data": {"object": {"id": "sub_1"}}},
        {"id": "evt_2", "type": "customer.subscriptionish", "data": {"object": {}}},
        {"id": "evt_3", "type": "invoice.paid", "data": {"object": {}}},
    ]
    assert [r.event_id for r in staging.stg_subscription_events(raw(spark, *docs)).collect()] == ["evt_1"]


def test_cents_are_exact(spark):
    docs = [{"id": f"ch_{i:07d}", "amount": i} for i in range(0, 2_999_999, 997)]
    rows = staging.stg_charges(raw(spark, *docs)).collect()
    assert all(r.amount == Decimal(int(r.charge_id[3:])) / 100 for r in rows)


def test_last_known_reason_survives_a_newer_subscription(spark):
    subs = spark.createDataFrame(
        [
            subscription("sub_1", "cus_1", start=datetime(2026, 1, 1), reason="payment_failed", status="canceled"),
            subscription("sub_2", "cus_1", plan="pro", start=datetime(2026, 2, 1)),
        ],
        SUB,
    )
    row = marts.customer_subscription_rollup(subs).first()
    assert (row.current_plan_key, row.subscription_status, row.cancellation_reason) == ("pro", "active", "payment_failed")


def test_lifecycle_classification(spark):
    subs = spark.createDataFrame([subscription("sub_1", "c"), subscription("sub_2", "c", "pro", 30)], SUB)
    day = datetime(2026, 1, 5)
    events = spark.createDataFrame(
        [
            ("start", CREATED, "sub_1", "c", None, "basic", day, None),
            ("up", UPDATED, "sub_1", "c", "basic", "pro", day, None),
            ("down", UPDATED, "sub_1", "c", "pro", "basic", day, None),
            ("same", UPDATED, "sub_1", "c", None, "basic", day, None),
            ("retired plan", UPDATED, "sub_1", "c", "gone", "basic", day, None),
            ("unknown subscription", CREATED, "sub_9", "c", None, "basic", day, None),
            ("start on retired plan", CREATED, "sub_2", "c", None, "gone", day, None),
            ("end", DELETED, "sub_1", "c", None, "basic", day, None),
        ],
        EVENT,
    )
    facts = marts.fct_subscription_events(events, subs, marts.dim_plan(subs))
    got = {r.event_id: (r.event_type, r.occurred_at, r.mrr_before, r.mrr_after) for r in facts.collect()}
    assert got == {
        "start": ("started", day, 0, 10),
        "up": ("upgraded", day, 10, 30),
        "down": ("downgraded", day, 30, 10),
        "start on retired plan": ("started", day, 0, None),
        "end": ("canceled", None, 10, 0),
    }


def facts(spark, *rows):
    """(event, subscription, customer, kind, time, mrr after)."""
    full = [(e, s, c, k, t, "p", Decimal(0), None if m is None else Decimal(m)) for e, s, c, k, t, m in rows]
    return spark.createDataFrame(full, FACT)


def roster(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "customer_id string")


def test_ties_boundaries_and_untimed_events(spark):
    events = facts(
        spark,
        ("e1", "s1", "a", "started", datetime(2026, 1, 10), 10),
        ("e2", "s1", "a", "upgraded", datetime(2026, 1, 10), 30),  # same instant: the later id wins
        ("e3", "s1", "a", "canceled", datetime(2026, 3, 1), 0),  # belongs to March, not February
        ("e4", "s2", "b", "started", datetime(2026, 2, 1), 20),
        ("e5", "s2", "b", "canceled", None, 0),  # no time: the segment stays open
    )
    segments = {r.event_id: r.valid_to for r in marts.mrr_segments(events).collect()}
    assert segments["e1"] == datetime(2026, 1, 10)
    assert segments["e4"] is None
    grid = revenue.mrr_customer_monthly(roster(spark, "a", "b", "idle"), events).collect()
    cells = {(r.customer_id, r.month.month): (r.mrr, r.movement) for r in grid}
    assert cells == {
        ("a", 1): (30, "new"),
        ("a", 2): (30, None),
        ("a", 3): (0, "churn"),
        ("b", 1): (0, None),
        ("b", 2): (20, "new"),
        ("b", 3): (20, None),
        ("idle", 1): (0, None),
        ("idle", 2): (0, None),
        ("idle", 3): (0, None),
    }


def test_no_events_give_no_months(spark):
    events = facts(spark).filter("false")
    assert revenue.mrr_customer_monthly(roster(spark, "a"), events).count() == 0
    assert revenue.mrr_monthly(roster(spark, "a"), events).count() == 0


def test_customers_of_one_split_unfold_in_many_tasks(spark):
    events = facts(spark, ("e1", "s", "a", "any", datetime(2026, 1, 5), 10), ("e2", "s", "a", "any", datetime(2026, 3, 5), 20))
    customers = spark.range(0, 50_000, 1, 1).selectExpr("sha2(string(id), 256) AS customer_id")
    grid = revenue.customer_month_grid(customers, events).cache()
    assert grid.count() == 150_000
    assert grid.select(F.spark_partition_id()).distinct().count() > 1


def random_facts(seed, customers=40):
    """Concurrent subscriptions, returns, ties, untimed events, unknown customers and plans."""
    rng = random.Random(seed)
    rows, n = [], 0
    for c in range(customers):
        for s in range(rng.choice([0, 1, 1, 2])):
            at = datetime(2025, 1, 1) + timedelta(days=rng.randint(20, 500))
            for _ in range(rng.randint(1, 6)):
                n += 1
                mrr = rng.choice([0, 0, 10, 20, 30, None])
                when = None if rng.random() < 0.05 else at
                rows.append((f"e{n:04d}", f"s{c}_{s}", f"c{c}", "any", when, mrr))
                at += timedelta(days=rng.choice([0, 0, 3, 30, 60, 200]))
    # Events of unknown customers come first and last, so they alone set the calendar's ends.
    rows.append(("e9998", "x", "stranger", "started", datetime(2024, 11, 3), 10))
    rows.append(("e9999", "x", "stranger", "canceled", datetime(2028, 2, 3), 0))
    return rows


def month_after(month):
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def by_hand(rows, customers):
    """(customer, month, mrr, movement, change) by walking through the calendar with each customer."""
    timed = sorted((t, e, s, c, m) for e, s, c, _, t, m in rows if t is not None)
    month, last = timed[0][0].date().replace(day=1), timed[-1][0].date()
    calendar = []
    while month <= last:
        calendar.append(month)
        month = month_after(month)
    found = []
    for customer in customers:
        before, paid = Decimal(0), False
        for month in calendar:
            end = datetime.combine(month_after(month), datetime.min.time())
            open_now = {}
            for at, _, subscription, owner, mrr in timed:
                if at < end:
                    open_now[subscription] = (owner, mrr or 0)  # the last event before the month's end stands
            now = Decimal(sum(mrr for owner, mrr in open_now.values() if owner == customer))
            if now == before:
                movement = None
            elif now > before:
                movement = "expansion" if before else "reactivation" if paid else "new"
            else:
                movement = "contraction" if now else "churn"
            found.append((customer, month, now, movement, now - before))
            before, paid = now, paid or now > 0
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_change_points_equal_a_walk_through_the_calendar(spark, seed):
    rows = random_facts(seed)
    names = [f"c{i}" for i in range(40)]
    brute = by_hand(rows, names)

    events, customers = facts(spark, *rows), roster(spark, *names)
    dense = revenue.mrr_customer_monthly(customers, events).collect()
    assert sorted((r.customer_id, r.month, r.mrr, str(r.movement)) for r in dense) == sorted(
        (c, m, x, str(k)) for c, m, x, k, _ in brute
    )

    monthly = {r.month: r for r in revenue.mrr_monthly(customers, events).collect()}
    for month in sorted({b[1] for b in brute}):
        cells = [b for b in brute if b[1] == month]
        r = monthly[month]
        assert (r.mrr, r.active_customers) == (sum(b[2] for b in cells), sum(b[2] > 0 for b in cells))
        for kind in revenue.MOVEMENTS:
            assert r[f"{kind}_mrr"] == sum(b[4] for b in cells if b[3] == kind)
        assert (r.new_customers, r.churned_customers) == tuple(sum(b[3] == k for b in cells) for k in ("new", "churn"))
    assert len(monthly) == len({b[1] for b in brute})

    # Cohorts: some signed up before the first month, some after the last.
    starts = {n: date(2024, 3, 1) if i % 5 == 0 else date(2025 + i % 2, 1 + i % 12, 1) for i, n in enumerate(names)}
    starts[names[7]] = date(2030, 1, 1)
    dim = spark.createDataFrame([(n, s, f"plan{i % 3}") for i, (n, s) in enumerate(starts.items())], "customer_id string, cohort_month date, current_plan_key string")
    want = {}
    for c, m, x, _, _ in brute:
        if m >= starts[c]:
            since = (m.year - starts[c].year) * 12 + m.month - starts[c].month
            active, total = want.get((starts[c], since), (0, 0))
            want[starts[c], since] = (active + (x > 0), total + 1)
    got = {(r.cohort_month, r.months_since): (r.n_active, r.n_customers) for r in dashboard.cohort_retention(dim, events).collect()}
    assert got == want

    paying = {}
    for c, _, x, _, _ in brute:
        plan = f"plan{names.index(c) % 3}"
        paying[plan] = paying.get(plan, 0) + (x > 0)
    assert {r[0]: r[1] for r in analyses.customer_months_by_plan(dim, events).collect()} == paying


def test_crosstabs_show_values_nobody_listed(spark):
    rows = [("p", "active", None), ("p", "paused", "customer_service"), ("p", "paused", "moved"), ("q", "canceled", "moved"), (None, "active", "moved")]
    customers = spark.createDataFrame(rows, "current_plan_key string, subscription_status string, cancellation_reason string")
    statuses = {(r.current_plan_key, r.subscription_status): (r.customers, r.churn_pct) for r in analyses.plan_status_crosstab(customers).collect()}
    assert statuses == {("p", "active"): (1, 0.0), ("p", "paused"): (2, 0.0), ("q", "canceled"): (1, 100.0)}
    reasons = {tuple(r) for r in analyses.plan_reason_crosstab(customers).collect()}
    assert reasons == {("p", "customer_service", 1), ("p", "moved", 1), ("q", "moved", 1)}


def test_the_document_sorts_and_quotes_whatever_names_it_gets(spark):
    series = spark.createDataFrame([("2026-02-01", 2.0), ("2026-01-01", 1.0)], "month string, mrr double")
    plans = spark.createDataFrame([(None, 1), ("\x7fplan", 2), ('a "b"', 3)], "plan string, active bigint")
    cohorts = spark.createDataFrame([("2026-01", 10, 0.5), ("2026-01", 9, None)], "cohort string, months_since int, retained double")
    unpaid = spark.createDataFrame([(Decimal("1.50"),)], "unpaid_amount decimal(12,2)")
    made = json.loads(dashboard.dashboard_payload("at 'noon'", series, plans, cohorts, unpaid).first()["payload"])
    assert made["generated_at"] == "at 'noon'" and made["unpaid_amount"] == 1.5
    assert [m["month"] for m in made["mrr_monthly"]] == ["2026-01-01", "2026-02-01"]
    assert [p["plan"] for p in made["plans"]] == ['a "b"', "\x7fplan", None]
    assert [(c["months_since"], c["retained"]) for c in made["cohorts"]] == [(9, None), (10, 0.5)]


def test_a_document_that_cannot_be_read_raises(spark):
    broken = spark.createDataFrame([("ch_1", '{"id": "ch_1", "amount": 1')], "id string, data string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        staging.stg_charges(broken).collect()


def test_long_numbers_keep_all_their_digits(spark):
    from subtally.sources.demo_billing import padded

    ids = spark.createDataFrame([(n,) for n in (7, 1000000000000, 10000000000012)], "n bigint").selectExpr(f"{padded('x', 'n')} AS id")
    assert [r.id for r in ids.collect()] == ["x000000000007", "x1000000000000", "x10000000000012"]


def test_waterfall_explains_every_month(spark, sf_dir):
    from subtally.plans.demo import Book

    rows = Book(spark, sf_dir).mrr_monthly.orderBy("month").collect()
    for a, b in zip(rows, rows[1:]):
        assert b.mrr - a.mrr == sum(b[f"{kind}_mrr"] for kind in revenue.MOVEMENTS)


def test_division_and_rounding_edges(spark):
    one = spark.range(1)

    def value(expression):
        return one.selectExpr(f"{expression} AS v").first()[0]

    assert value(ratio("1", "0")) == float("inf")
    assert value(ratio("-1", "0")) == float("-inf")
    assert str(value(ratio("0", "0"))) == "nan"
    assert value(ratio("1", "NULL")) is None
    assert value(finite(f"({ratio('1', '0')})")) is None
    assert value(round_scaled("1.005D", 2)) == 1.0
    assert value(round_half_even("0.25D", 1)) == 0.2


def test_ltv_of_a_plan_nobody_left_is_infinite(spark):
    plans = spark.createDataFrame([("p", "P", "month", Decimal(10)), ("q", "Q", "month", Decimal(20))], "plan_key string, plan_name string, billing_interval string, mrr_amount decimal(12,2)")
    months = spark.createDataFrame([("p", 50), ("q", 40)], "current_plan_key string, customer_months long")
    cancellations = spark.createDataFrame([("p", 1)], "plan_key string, cancellations long")
    customers = spark.createDataFrame([("p", Decimal(7)), ("p", Decimal(9))], "current_plan_key string, lifetime_revenue decimal(22,2)")
    rows = {r.plan_key: r for r in analyses.ltv_by_plan(plans, months, cancellations, customers).collect()}
    assert (rows["p"].expected_ltv, rows["p"].realized_revenue_per_customer) == (500.0, 8.0)
    assert (rows["q"].expected_ltv, rows["q"].cancellations) == (float("inf"), 0)


def test_the_whole_event_type_decides(spark):
    """Only the API's own two types start and end a subscription; a longer type with the same last word doesn't."""
    at = datetime(2026, 1, 1)
    types = ["customer.subscription.created", "customer.subscription.x.created", "customer.subscription.deleted", "x.deleted"]
    rows = [(f"e{i}", t, "s", "c", None, "p", at, at) for i, t in enumerate(types)]
    staged = spark.createDataFrame(
        rows, "event_id string, event_type string, subscription_id string, customer_id string, previous_plan_key string, "
        "plan_key string, period_start timestamp, canceled_at timestamp"
    )
    plans = spark.createDataFrame([("p", Decimal("5.00"))], "plan_key string, mrr_amount decimal(12,2)")
    found = marts.fct_subscription_events(staged, spark.createDataFrame([("s",)], "subscription_id string"), plans)
    assert sorted((r.event_id, r.event_type, r.mrr_before, r.mrr_after) for r in found.collect()) == [
        ("e0", "started", 0, 5),
        ("e2", "canceled", 5, 0),
    ]


def priced_event(i, kind, sub, day, plan, cents, before=None, interval="month"):
    price = {"lookup_key": plan, "unit_amount": cents, "recurring": {"interval": interval}}
    at = int((datetime(2026, 1, 1) + timedelta(days=day)).timestamp())
    previous = {"items": {"data": [{"price": {"lookup_key": before}}]}} if before else None
    items = {"data": [{"price": price, "current_period_start": at}]}
    return {"id": i, "type": kind, "data": {"object": {"id": sub, "customer": "c", "items": items}, "previous_attributes": previous}}


def test_events_can_be_priced_by_what_they_carry(spark):
    """A plan nobody holds now, a price that rose, and a yearly one; the plan list of today knows none of the three."""
    events = raw(
        spark,
        priced_event("e1", CREATED, "s", 1, "old", 1000),
        priced_event("e2", UPDATED, "s", 40, "gone", 24000, "old", "year"),
        priced_event("e3", CREATED, "t", 50, "old", 3000),
        priced_event("e4", UPDATED, "s", 60, "old", 3000, "gone"),
        priced_event("e5", CREATED, "t", 50, "old", 2900),  # the same instant: the later id counts
        {"id": "e6", "type": UPDATED, "data": {"object": {"id": "s", "items": {"data": []}}}},
    )
    prices = marts.plan_prices(staging.event_prices(events))
    day = [datetime(2026, 1, 1) + timedelta(days=d) for d in range(61)]
    assert sorted((r.plan_key, float(r.mrr_amount), r.valid_from, r.valid_to) for r in prices.collect()) == [
        ("gone", 20.0, None, None),
        ("old", 10.0, None, day[50]),
        ("old", 29.0, day[50], day[60]),
        ("old", 30.0, day[60], None),
    ]
    found = {r.event_id: r for r in prices_of(spark, events, prices).collect()}
    assert {i: (r.event_type, r.plan_key, float(r.mrr_before), float(r.mrr_after)) for i, r in found.items()} == {
        "e1": ("started", "old", 0.0, 10.0),
        "e2": ("upgraded", "gone", 10.0, 20.0),
        "e3": ("started", "old", 0.0, 29.0),
        "e4": ("upgraded", "old", 20.0, 30.0),
        "e5": ("started", "old", 0.0, 29.0),
    }


def prices_of(spark, events, prices):
    known = spark.createDataFrame([("s",), ("t",)], "subscription_id string")
    return marts.fct_subscription_events_at_own_prices(staging.stg_subscription_events(events), known, prices)
