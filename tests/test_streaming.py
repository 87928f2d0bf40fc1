import json
from datetime import datetime

import pytest

from subtally import job
from subtally.operators.ingest import drop_dead_clock_cascade, latest_snapshot, parse_feed, route_snapshots
from subtally.streaming.load import changed_objects, feed_from_files, read_changes, stream_load


def event(n, kind, obj, type_="x.updated"):
    return {"id": f"evt_{n}", "type": type_, "created": n, "data": {"object": {"object": kind, **obj}}}


def land(folder, name, events):
    path = folder / f"{name}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(events, indent=2))


# Two files of the first sync: the clock that the second deletes takes along what the first has of it.
FIRST = [
    event(1, "customer", {"id": "cus_1", "v": 1}),
    event(2, "customer", {"id": "cus_1", "v": 2}),
    event(3, "subscription", {"id": "sub_1", "test_clock": "dead", "v": 1}),
    event(4, "subscription", {"id": "sub_2", "v": 1}),
    event(5, "subscription", {"id": "sub_2", "test_clock": "dead", "v": 2}),
]
SECOND = [
    event(6, "test_helpers.test_clock", {"id": "dead"}, "test_helpers.test_clock.deleted"),
    event(7, "invoice", {"status": "preview"}),
    event(8, "customer", {"id": "cus_2", "v": 1}),
]
THIRD = [event(9, "subscription", {"id": "sub_1", "test_clock": "dead", "v": 3}), event(10, "payment_intent", {"id": "pi_1"})]


@pytest.mark.parametrize("max_files", [1, 10])
def test_stream_equals_batch_whatever_the_files_and_micro_batches(spark, tmp_path, max_files):
    landing, changes, checkpoint = tmp_path / "events", str(tmp_path / "changes"), str(tmp_path / "cp")
    land(landing, "sync=2026-01-01/block=1/a", FIRST)
    land(landing, "sync=2026-01-01/block=2/a", SECOND)
    stream_load(spark, str(landing), changes, checkpoint, max_files)
    land(landing, "sync=2026-01-02/block=1/a", THIRD)
    for _ in range(2):  # the second finds nothing new
        stream_load(spark, str(landing), changes, checkpoint, max_files)
    current = {(r.type, r.id): json.loads(r.data) for r in read_changes(spark, changes).collect()}
    objects = {k: d["v"] for k, d in current.items() if k[0] != "events"}
    assert objects == {("customers", "cus_1"): 2, ("customers", "cus_2"): 1, ("subscriptions", "sub_1"): 3, ("subscriptions", "sub_2"): 1}
    assert sorted(int(i[4:]) for t, i in current if t == "events") == [1, 2, 4, 6, 7, 8, 9, 10]

    rows = [(sync, -n, json.dumps(e)) for sync, n, e in [("1", i, e) for i, e in enumerate(FIRST + SECOND)] + [("2", 100 + i, e) for i, e in enumerate(THIRD)]]
    feed = parse_feed(spark.createDataFrame(rows, "batch string, source_pos bigint, data string"))
    routed = route_snapshots(drop_dead_clock_cascade(feed)).selectExpr("type", "id", "batch AS file", "-source_pos AS pos", "data")
    batch = latest_snapshot(routed, by=("type", "id"))
    assert {(r.type, r.id): json.loads(r.data)["v"] for r in batch.collect()} == objects


def test_a_file_in_a_flat_folder_is_a_sync(spark, tmp_path):
    landing = tmp_path / "events"
    land(landing, "2026-01-01T00-00-00Z", FIRST)
    land(landing, "2026-01-02T00-00-00Z", SECOND)
    stream_load(spark, str(landing), str(tmp_path / "changes"), str(tmp_path / "cp"))
    assert read_changes(spark, str(tmp_path / "changes")).filter("type = 'subscriptions'").count() == 2


def test_a_truncated_file_stops_the_stream(spark, tmp_path):
    landing = tmp_path / "events"
    land(landing, "a", FIRST)
    (landing / "b.json").write_text('[{"id": "evt_1"')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        stream_load(spark, str(landing), str(tmp_path / "changes"), str(tmp_path / "cp"))


def test_folding_keeps_what_came_from_later_files(spark, tmp_path):
    """Stream day 1, batch load day 10, stream day 11: the batch load's newer customer stays."""
    warehouse, feed, landed = str(tmp_path / "w"), tmp_path / "feed", tmp_path / "landing"

    def stream(day, events):
        land(feed, f"2026-01-{day:02d}T00-00-00Z", events)
        stream_load(spark, str(feed), f"{warehouse}/changes", f"{warehouse}/cp")
        job.fold_stream(spark, warehouse, datetime(2026, 1, day))

    def customers():
        return {r.id: (json.loads(r.data)["v"], r.loaded_at.day) for r in job.raw_tables(spark, warehouse)["customers"].collect()}

    stream(1, [event(1, "customer", {"id": "cus_1", "v": 1}), event(2, "customer", {"id": "cus_0", "v": 1})])
    land(landed / "customers", "2026-01-10T00-00-00Z", [{"id": "cus_1", "v": 10}])
    job.load_all(spark, str(landed), warehouse, datetime(2026, 1, 10))
    assert customers() == {"cus_0": (1, 1), "cus_1": (10, 10)}
    stream(11, [event(3, "customer", {"id": "cus_2", "v": 1})])
    assert customers() == {"cus_0": (1, 1), "cus_1": (10, 10), "cus_2": (1, 11)}
    job.fold_stream(spark, warehouse, datetime(2026, 1, 12))  # no new change set: nothing is written
    assert {day for _, day in customers().values()} == {1, 10, 11}


def test_a_clock_deleted_after_the_fold_takes_folded_rows_back(spark, tmp_path):
    """The deletion lands later, in another file of the same sync: the tables are as if it had been there at once."""
    feed = tmp_path / "feed"

    def fold(warehouse, day):
        stream_load(spark, str(feed), f"{warehouse}/changes", f"{warehouse}/cp")
        job.fold_stream(spark, warehouse, datetime(2026, 1, day))

    def tables(warehouse):
        return {n: sorted((r.id, r.data) for r in t.collect()) for n, t in job.raw_tables(spark, warehouse).items()}

    late, at_once = str(tmp_path / "late"), str(tmp_path / "once")
    land(feed, "sync=2025-12-31/block=1/a", [event(0, "subscription", {"id": "sub_3", "v": 0})])
    own = [event(11, "subscription", {"id": "sub_3", "test_clock": "dead", "v": 1}), event(12, "customer", {"id": "cus_9", "test_clock": "dead"})]
    land(feed, "sync=2026-01-01/block=1/a", FIRST + own)
    fold(late, 1)
    before = tables(late)
    assert {i for i, _ in before["subscriptions"]} == {"sub_1", "sub_2", "sub_3"} and ("cus_9" in dict(before["customers"]))
    land(feed, "sync=2026-01-01/block=2/a", SECOND)
    fold(late, 2)
    fold(at_once, 2)
    assert tables(late) == tables(at_once)
    after = dict(tables(late)["subscriptions"])
    assert set(after) == {"sub_2", "sub_3"} and json.loads(after["sub_2"])["v"] == 1 and json.loads(after["sub_3"])["v"] == 0
    assert "cus_9" not in dict(tables(late)["customers"])
    land(feed, "sync=2026-01-02/block=1/a", THIRD)
    fold(late, 3)
    fold(at_once, 3)
    assert tables(late) == tables(at_once)


def test_a_micro_batch_reads_and_parses_its_files_once(spark, tmp_path):
    land(tmp_path / "events", "sync=2026-01-01/block=1/a", FIRST + SECOND)
    files = spark.read.text(str(tmp_path / "events"), wholetext=True, recursiveFileLookup=True).selectExpr("'2026-01-01/1/a' AS file", "value")
    changed = changed_objects(parse_feed(feed_from_files(files), "file"))
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1 and plan.count("array<string>") <= 1
    found = {(r.type, r.id, r.test_clock): r.data and json.loads(r.data) for r in changed.collect()}
    assert found.pop(("clocks", "dead", None)) is None
    assert {k: v["v"] for k, v in found.items() if k[0] != "events"} == {
        ("customers", "cus_1", None): 2, ("customers", "cus_2", None): 1, ("subscriptions", "sub_1", "dead"): 1,
        ("subscriptions", "sub_2", None): 1, ("subscriptions", "sub_2", "dead"): 2,
    }
    assert len([k for k in found if k[0] == "events"]) == 8


def test_clocks_of_change_sets_written_beside_still_count(spark, tmp_path):
    """Change sets of the layout before had their deleted clocks in a folder of their own."""
    changes = str(tmp_path / "changes")
    land(tmp_path / "events", "sync=2026-01-01/block=1/a", FIRST)
    stream_load(spark, str(tmp_path / "events"), changes, str(tmp_path / "cp"))
    assert read_changes(spark, changes).filter("id = 'sub_1'").count() == 1
    spark.createDataFrame([("2026-01-01", "dead")], "batch string, _clock string").write.parquet(f"{changes}/clocks/batch_id=0")
    assert read_changes(spark, changes).filter("id = 'sub_1'").count() == 0
