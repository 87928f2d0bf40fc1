"""Refreshed revenue tables against a build from nothing, over random change sets."""

import random
from datetime import datetime
from decimal import Decimal

import pytest

from subtally.plans import refresh, revenue
from subtally.sources import buckets

EVENT = "event_id string, event_type string, subscription_id string, customer_id string, previous_plan_key string, plan_key string, period_start timestamp, canceled_at timestamp"
KINDS = ["customer.subscription.created", "customer.subscription.updated", "customer.subscription.deleted", "invoice.paid"]


class World:
    """Events, subscriptions and customers that change from day to day, and what changed since the last look."""

    def __init__(self, spark, seed):
        self.spark, self.rng = spark, random.Random(seed)
        self.events, self.subscriptions, self.customers = {}, set(), set()
        self.plans = spark.createDataFrame([(f"p{i}", Decimal(i * 5)) for i in range(1, 5)], "plan_key string, mrr_amount decimal(12,2)")

    def event(self, number):
        rng = self.rng
        kind, sub = rng.choice(KINDS), rng.choice([None, *(f"s{i}" for i in range(40))])
        at = datetime(2026, rng.randint(1, 12), rng.randint(1, 28)) if rng.random() < 0.95 else None
        customer = f"c{int(sub[1:]) % 25}" if sub and rng.random() < 0.9 else rng.choice([None, "c1", "c30"])  # now and then it moves
        plans = [None, *(f"p{i}" for i in range(1, 6))]
        return (f"e{number}", kind, sub, customer, rng.choice(plans), rng.choice(plans), at, at)

    def step(self, events, subscriptions, customers):
        """Changed events (some of them known ones that come with other content) and what was loaded with them."""
        numbers = {self.rng.randrange(events * 4) for _ in range(events)}
        came = {n: self.event(n) for n in numbers}
        self.events.update(came)
        subs = {f"s{self.rng.randrange(40)}" for _ in range(subscriptions)}
        people = {f"c{self.rng.randrange(28)}" for _ in range(customers)}
        self.subscriptions |= subs
        self.customers |= people
        frame = self.spark.createDataFrame

        def names(values, name):
            return frame([(v,) for v in sorted(values)], f"{name} string")

        rows = [e for e in came.values() if e[1].startswith("customer.subscription.")]
        return refresh.Loaded(
            events=frame(rows, EVENT),
            event_ids=names({e[0] for e in came.values()}, "event_id"),
            subscriptions=names(subs, "subscription_id"),
            customers=names(people, "customer_id"),
            subscription_ids=names(self.subscriptions, "subscription_id"),
            customer_ids=names(self.customers, "customer_id"),
        )

    def expected(self, loaded):
        from subtally.plans import marts

        rows = [e for e in self.events.values() if e[1].startswith("customer.subscription.")]
        facts = marts.fct_subscription_events(self.spark.createDataFrame(rows, EVENT), loaded.subscription_ids, self.plans)
        return facts, revenue.mrr_monthly(loaded.customer_ids, facts), revenue.mrr_customer_monthly(loaded.customer_ids, facts)


def rows_of(frame):
    columns = sorted(frame.columns)
    return sorted(str(tuple(str(r[c]) if not isinstance(r[c], Decimal) else float(r[c]) for c in columns)) for r in frame.collect())


def assert_same(spark, root, world, loaded):
    facts, monthly, dense = world.expected(loaded)
    assert rows_of(refresh.lifecycle_events(spark, root)) == rows_of(facts)
    assert rows_of(refresh.mrr_monthly(spark, root)) == rows_of(monthly)
    assert rows_of(refresh.mrr_customer_monthly(spark, root, loaded.customer_ids)) == rows_of(dense)


@pytest.mark.parametrize("seed", [1])
def test_refreshing_equals_building_from_nothing(spark, tmp_path, seed):
    world, root = World(spark, seed), str(tmp_path / "r")
    for day, sizes in enumerate([(60, 20, 15), (10, 3, 4), (1, 0, 0)], 1):
        loaded = world.step(*sizes)
        refresh.refresh(spark, root, f"v{day}", loaded, world.plans, n=8)
        if day > 1:
            assert_same(spark, root, world, loaded)


def test_only_touched_buckets_are_written_and_a_crash_is_taken_back(spark, tmp_path, monkeypatch):
    world, root = World(spark, 3), str(tmp_path / "r")
    refresh.refresh(spark, root, "v1", world.step(80, 40, 28), world.plans, n=16)
    before = {t: buckets.manifest(spark, f"{root}/{t}") for t in ("lifecycle", "deltas", "changes")}
    loaded = world.step(1, 0, 0)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "write_version", crash)
        with pytest.raises(RuntimeError):
            refresh.refresh(spark, root, "v2", loaded, world.plans, n=16)
    assert buckets.manifest(spark, f"{root}/changes") != before["changes"]
    refresh.refresh(spark, root, "v3", loaded, world.plans, n=16)
    assert_same(spark, root, world, loaded)
    for table, held in before.items():
        now = buckets.manifest(spark, f"{root}/{table}")
        assert sum(now[b] != held[b] for b in held) <= 4, table
    refresh.refresh(spark, root, "v3", loaded, world.plans, n=16)  # the same again
    assert_same(spark, root, world, loaded)


def test_nothing_loaded(spark, tmp_path):
    world, root = World(spark, 4), str(tmp_path / "r")
    for version in ("v1", "v2"):
        refresh.refresh(spark, root, version, world.step(0, 0, 0), world.plans, n=4)
    assert refresh.mrr_monthly(spark, root).count() == 0


def test_stored_events_are_shuffled_once_a_refresh(spark, tmp_path, monkeypatch):
    """Events that came again go, also one that had no subscription, and no join deals the stored rows by another key."""
    world, root, plans = World(spark, 5), str(tmp_path / "r"), []
    refresh.refresh(spark, root, "v1", world.step(60, 20, 15), world.plans, n=8)
    replace = refresh.replace_buckets

    def seen(table, version, rows, *rest):
        if table.endswith("lifecycle"):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return replace(table, version, rows, *rest)

    monkeypatch.setattr(refresh, "replace_buckets", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loaded = world.step(40, 5, 4)
        refresh.refresh(spark, root, "v2", loaded, world.plans, n=8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(event_id" not in plans[0]
    assert_same(spark, root, world, loaded)


def test_both_syncs_land_documents_that_are_made_once(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    orders = [(k, k % 7, "F", float(k), datetime(1997, 1 + k % 12, 1 + k % 28), "1-URGENT") for k in range(1, 60)]
    given = {
        "customer": [(c, f"C#{c}", 1, 1.0, "X") for c in range(7)],
        "supplier": [(1, "S#1", 1, 1.0)],
        "orders": orders,
    }
    for name, rows in given.items():
        spark.createDataFrame(rows, entry.demo_billing.TABLES[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    read, write = [], entry.landing.write_landing
    monkeypatch.setattr(entry.landing, "write_landing", lambda df, *rest: read.append(df.inputFiles()) or write(df, *rest))
    found = entry.queries()["mrr_monthly_refresh"](spark, str(tmp_path))
    whole = entry.queries()["mrr_monthly"](spark, str(tmp_path))
    assert len(read) == 6 and not [f for files in read for f in files if f.startswith(f"file://{tmp_path}")]
    assert rows_of(found) == rows_of(whole)


def test_a_first_refresh_writes_each_table_once_and_none_sorts_rows_to_look_up_ids(spark, tmp_path, monkeypatch):
    """With broadcasts off, as large tables have it: a build from nothing stores no rows aside, and marks are hashed."""
    world, root, aside, tables = World(spark, 6), str(tmp_path / "r"), [], []
    replace, written = refresh.replace_buckets, refresh.written

    def seen(table, version, rows, *rest):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        tables.append(table.rsplit("/", 1)[1])
        assert tables[-1] == "deltas" or "SortMergeJoin" not in plan
        return replace(table, version, rows, *rest)

    monkeypatch.setattr(refresh, "replace_buckets", seen)
    monkeypatch.setattr(refresh, "written", lambda df, *rest, **more: aside.append(df) or written(df, *rest, **more))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refresh.refresh(spark, root, "v1", world.step(60, 20, 15), world.plans.hint("broadcast"), n=8)
        assert not aside and tables == ["lifecycle", "deltas", "changes"]
        loaded = world.step(40, 5, 4)
        refresh.refresh(spark, root, "v2", loaded, world.plans.hint("broadcast"), n=8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tables) == 6
    assert_same(spark, root, world, loaded)
