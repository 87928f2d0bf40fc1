import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subtally.operators.history import read_history, scd2_apply, scd2_rebuild, snapshot_run, state_as_of
from subtally.sources.tables import versions
from subtally.streaming.history import apply_snapshots, read_stream_history, stream_history

CHECK = ("status", "plan_key")
BATCH = "sub string, status string, plan_key string, note int, run timestamp"


def random_batches(seed, keys=12, runs=6):
    rng = random.Random(seed)
    start = datetime(2026, 1, 1)
    rows = []
    for run in range(runs):
        for key in range(keys):
            if rng.random() < 0.6:
                status = rng.choice(["active", "past_due", None])
                plan = rng.choice(["basic", "pro", None])
                rows.append((f"sub_{key}", status, plan, run, start + timedelta(days=run)))
    return rows


def as_set(frame):
    return sorted(map(str, frame.select("sub", "status", "plan_key", "note", "valid_from", "valid_to").collect()))


def test_folding_runs_equals_the_rebuild(spark, tmp_path):
    batches = spark.createDataFrame(random_batches(1), BATCH)
    runs = sorted(r.run for r in batches.select("run").distinct().collect())
    history = None
    for run in runs:
        batch = batches.filter(F.col("run") == F.lit(run)).drop("run")
        snapshot_run(spark, str(tmp_path / "h"), batch, "sub", CHECK, run)
        if history is None:
            history = batch.withColumn("valid_from", F.lit(run)).withColumn("valid_to", F.lit(None).cast("timestamp"))
        else:
            history = scd2_apply(history, batch, "sub", CHECK, run)
    # Repeating the last run changes nothing.
    snapshot_run(spark, str(tmp_path / "h"), batch, "sub", CHECK, run)
    rebuilt = as_set(scd2_rebuild(batches, "sub", CHECK, "run"))
    assert as_set(history) == rebuilt
    assert as_set(read_history(spark, str(tmp_path / "h"))) == rebuilt


def test_history_invariants(spark):
    history = scd2_rebuild(spark.createDataFrame(random_batches(2, 30, 10), BATCH), "sub", CHECK, "run")
    rows = sorted(history.collect(), key=lambda r: (r["sub"], r.valid_from))
    for a, b in zip(rows, rows[1:]):
        if a["sub"] == b["sub"]:
            assert a.valid_to == b.valid_from
            assert (a.status, a.plan_key) != (b.status, b.plan_key)
        else:
            assert a.valid_to is None
    assert rows[-1].valid_to is None


def test_state_as_of_is_half_open(spark):
    rows = [("sub_1", "active", datetime(2026, 1, 1), datetime(2026, 3, 1)), ("sub_1", "canceled", datetime(2026, 3, 1), None)]
    history = spark.createDataFrame(rows, "sub string, status string, valid_from timestamp, valid_to timestamp")

    def at(day):
        return [r.status for r in state_as_of(history, day).collect()]

    assert at(datetime(2025, 12, 31)) == []
    assert at(datetime(2026, 2, 1)) == ["active"]
    assert at(datetime(2026, 3, 1)) == ["canceled"]


def test_a_stream_of_snapshots_leaves_the_rebuilt_history(spark, tmp_path):
    """Lots with one run and with several, a restart before each, and a batch that is replayed."""
    rows = random_batches(4, keys=20, runs=7)
    whole = spark.createDataFrame(rows, BATCH)
    landing, root, checkpoint = (str(tmp_path / name) for name in ("landing", "history", "checkpoint"))
    days = sorted({r[-1] for r in rows})
    for lot in (days[:1], days[1:4], [], days[4:]):
        spark.createDataFrame([r for r in rows if r[-1] in lot], BATCH).coalesce(1).write.mode("append").parquet(landing)
        stream_history(spark, landing, whole.schema, root, checkpoint, "sub", CHECK)
    rebuilt = as_set(scd2_rebuild(whole, "sub", CHECK, "run"))
    assert as_set(read_stream_history(spark, root, whole.schema)) == rebuilt
    last = spark.createDataFrame([r for r in rows if r[-1] in days[4:]], BATCH)
    label = versions(spark, f"{root}/open/manifest")[-1]
    apply_snapshots(spark, root, last, "sub", CHECK, "run", label)
    assert as_set(read_stream_history(spark, root, whole.schema)) == rebuilt
    known = last.first()
    late = spark.createDataFrame([(known["sub"], "late", None, 0, days[0] - timedelta(days=9))], BATCH)
    with pytest.raises(Exception, match="older than the open row"):
        apply_snapshots(spark, root, late, "sub", CHECK, "run", f"{int(label) + 1:012d}")
    assert as_set(read_stream_history(spark, root, whole.schema)) == rebuilt


def test_a_history_without_runs(spark, tmp_path):
    schema = "sub string, status string, valid_from timestamp, valid_to timestamp"
    assert read_history(spark, str(tmp_path / "h"), schema).count() == 0
    with pytest.raises(ValueError, match="no snapshot run"):
        read_history(spark, str(tmp_path / "h"))
    empty = spark.createDataFrame([], BATCH)
    assert read_stream_history(spark, str(tmp_path / "s"), empty.schema).count() == 0
