"""The batch job end to end on landing files derived from the demo tables."""

import json
from datetime import date, datetime

from subtally import job
from subtally.operators import quality
from subtally.plans.demo import Book
from subtally.sources import demo_billing, landing


def test_load_build_check_export(spark, sf_dir, tmp_path):
    root, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    for name, build in demo_billing.RAW.items():
        rows = build(spark, sf_dir).selectExpr("monotonically_increasing_id() AS pos", "data")
        landing.write_landing(rows, root, name, "2026-09-01T00-00-00Z")
    for day in (2, 3):  # the second run finds nothing new
        at = datetime(2026, 9, day)
        job.load_all(spark, root, warehouse, at)
        built = job.build(spark, warehouse, at)
    history = built["dim_subscription_history"]
    assert history.count() == built["stg_subscriptions"].count()
    assert history.filter("NOT is_current").count() == 0

    report = job.check_all(spark, warehouse)
    assert report.count() == 36
    assert report.filter("NOT passed").count() == 0

    document = json.loads(job.export(spark, warehouse, datetime(2026, 9, 3)).first()["payload"])
    assert set(document) == {"generated_at", "mrr_monthly", "plans", "cohorts", "unpaid_amount"}
    months = [m["month"] for m in document["mrr_monthly"]]
    assert months == sorted(months) and len(months) == built["mrr_monthly"].count()
    assert isinstance(document["mrr_monthly"][-1]["mrr"], float)
    assert [p["plan"] for p in document["plans"]][-1] is None
    assert set(document["cohorts"][0]) == {"cohort", "months_since", "retained"}
    assert document["unpaid_amount"] > 0
    found = job.analyze(spark, warehouse)
    assert len(found) == 15 and found["ltv_by_plan"].count() == built["dim_plan"].count()
    assert all(frame.columns for frame in found.values()) and found["kpi_latest"].count() == 1
    assert job.as_of(spark, warehouse, datetime(2026, 9, 2, 12)).count() == history.count()
    assert job.as_of(spark, warehouse, datetime(2026, 9, 1)).count() == 0
    limits = {"customers": (1, 5)}
    assert [r.rule for r in job.check_all(spark, warehouse, **limits).filter("NOT passed").collect()] == ["row_count_between"]
    assert job.run_check(spark, warehouse, datetime(2026, 9, 3), {}) == 0
    assert job.run_check(spark, warehouse, datetime(2026, 9, 3), limits) == 1


def test_rules_report_failures(spark):
    t = spark.createDataFrame([("a", 1, True), ("a", -1, True), (None, None, False)], "k string, v int, is_current boolean")
    p = spark.createDataFrame([("b",)], "k string")
    rules = [
        quality.Unique("t", "k"),
        quality.NotNull("t", "k"),
        quality.AcceptedValues("t", "k", ("b",)),
        quality.ValuesBetween("t", "v", 0, None),
        quality.Relationship("t", "k", "p", "k"),
        quality.RowCountBetween("t", 4, None),
        quality.OneCurrentRow("t", "k"),
    ]
    got = {r.rule: (r.n_failed, r.passed) for r in quality.check({"t": t, "p": p}, rules).collect()}
    assert got == {
        "unique": (1, False),
        "not_null": (1, False),
        "accepted_values": (2, False),
        "values_between": (1, False),
        "relationships": (2, False),
        "row_count_between": (1, False),
        "one_current_row": (1, False),
    }


def test_values_of_several_types_are_counted_in_their_type(spark):
    rows = [(1, "a", date(2026, 1, 1), True), (1, "1", date(2026, 1, 1), True), (2, "a", None, None), (None, None, None, True)]
    tables = {"t": spark.createDataFrame(rows, "n bigint, s string, d date, open boolean")}
    columns = ("n", "s", "d")
    rules = [quality.Unique("t", c) for c in columns] + [quality.OneCurrentRow("t", "n", "open"), quality.Unique("none", "n")]
    tables["none"] = tables["t"].filter("false")
    found = quality.check(tables, rules)
    got = [(r.rule, r.table_name, r.column_name, r.n_failed, r.passed) for r in found.collect()]
    assert got == [*(("unique", "t", c, 1, False) for c in columns), ("one_current_row", "t", "n", 1, False), ("unique", "none", "n", 0, True)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(n#" not in plan and "cast(d#" not in plan


def test_a_stored_view_is_parsed_once(spark, sf_dir):
    names = ("stg_subscriptions", "stg_invoices", "stg_subscription_events")
    kept, plain = Book(spark, sf_dir, names), Book(spark, sf_dir)
    for name in names:
        plan = getattr(kept, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan
        assert getattr(kept, name).exceptAll(getattr(plain, name)).count() == 0
    assert "from_json" not in kept.fct_invoices._jdf.queryExecution().optimizedPlan().toString()


def test_freshness_levels(spark):
    def loaded(day):
        return spark.createDataFrame([(day,)], "loaded_at timestamp")

    raw = {"a": loaded(datetime(2026, 1, 9)), "b": loaded(datetime(2026, 1, 7)), "c": loaded(datetime(2026, 1, 1)), "d": loaded(None)}
    rows = quality.freshness(raw, datetime(2026, 1, 10)).collect()
    assert {r.table_name: r.status for r in rows} == {"a": "pass", "b": "warn", "c": "error", "d": "error"}


def test_dashboard_check(spark):
    series = spark.createDataFrame([(f"2026-{m:02d}-01", float(m)) for m in range(1, 13)], "month string, mrr double")
    assert quality.dashboard_check(series).first()["passed"]
    assert not quality.dashboard_check(series.filter("month > '2026-01-01'")).first()["passed"]
    assert not quality.dashboard_check(series.filter("false")).first()["passed"]


def test_incremental_sync_lands_what_changed(spark, tmp_path):
    def event(n, obj, type_="x.updated"):
        return json.dumps({"id": f"evt_{n}", "type": type_, "created": n, "data": {"object": obj}})

    def sync(day, *events):
        """Events are given oldest first; the feed lists the newest first."""
        rows = [(i, e) for i, e in enumerate(reversed(events))]
        feed = spark.createDataFrame(rows, "source_pos bigint, data string")
        return job.sync_feed(spark, feed, str(tmp_path / "l"), str(tmp_path / "s"), datetime(2026, 1, day))

    def customer(v):
        return {"object": "customer", "id": "cus_1", "v": v}

    start = int(datetime(2026, 1, 1).timestamp())
    assert sync(1, event(5, customer(1)), event(6, customer(2))) == start
    # The overlap of the cursor's own second is read again, older events are not.
    late = start + 9
    cursor = sync(2, event(start - 1, customer(0)), event(start, customer(3)), event(late, customer(4)))
    assert cursor == late
    assert sync(3) == late
    # A forced full sync reads everything again and starts from its own time.
    rows = spark.createDataFrame([(0, event(7, customer(0)))], "source_pos bigint, data string")
    full = job.sync_feed(spark, rows, str(tmp_path / "l2"), str(tmp_path / "s"), datetime(2026, 1, 5), full=True)
    assert full == int(datetime(2026, 1, 5).timestamp())
    assert spark.read.json(str(tmp_path / "l2/events")).count() == 1
    assert job.bounds_of("3:") == (3.0, None) and job.bounds_of(":7.5") == (None, 7.5)

    for _ in range(2):
        report = job.load_all(spark, str(tmp_path / "l"), str(tmp_path / "w"), datetime(2026, 1, 4))
        assert sorted((r.type, r.n_rows) for r in report.collect()) == [("customers", 1), ("events", 4)]
    data = job.raw_tables(spark, str(tmp_path / "w"))["customers"].first()["data"]
    assert json.loads(data)["v"] == 4
