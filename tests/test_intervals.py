import random
from datetime import datetime, timedelta

import pytest

from subtally.operators.intervals import covering, state_as_of_many
from subtally.operators.neighbours import with_last_known

START = datetime(2026, 1, 1)


def day(n):
    return None if n is None else START + timedelta(days=n)


def sample(seed):
    """Intervals and points on whole days, so that many of both meet; times before 1970, NULL keys and NULL times."""
    rng = random.Random(seed)
    intervals, points = [], []
    for i in range(200):
        first = rng.choice([None, -25_000, *range(0, 300)])
        last = None if first is None or rng.random() < 0.3 else first + rng.choice([0, 1, 7, 90])
        intervals.append((rng.choice(["a", "b", "c", None]), rng.randint(0, 1), f"i{i}", day(first), day(last)))
    for i in range(150):
        points.append((rng.choice(["a", "b", "d", None]), rng.randint(0, 1), f"p{i}", day(rng.choice([None, -25_000, -24_990, *range(0, 400)]))))
    return intervals, points


@pytest.mark.parametrize("closed", ["left", "right"])
@pytest.mark.parametrize("bin_seconds", [86_400, 40 * 86_400])
def test_points_meet_the_intervals_that_cover_them(spark, closed, bin_seconds):
    intervals, points = sample(4)
    found = covering(
        spark.createDataFrame(points, "key string, part int, point string, at timestamp"),
        spark.createDataFrame(intervals, "key string, part int, name string, first timestamp, last timestamp"),
        ["key", "part"], "at", "first", "last", closed, bin_seconds,
    )
    assert found.columns == ["key", "part", "point", "at", "name", "first", "last"]
    want = []
    for key, part, point, at in points:
        own = []
        for k, p, name, first, last in intervals:
            if key is None or at is None or first is None or (k, p) != (key, part):
                continue
            inside = first <= at and (last is None or at < last) if closed == "left" else first < at and (last is None or at <= last)
            if inside:
                own.append(name)
        want += [(point, name) for name in own or [None]]
    assert sorted(map(str, ((r.point, r.name) for r in found.collect()))) == sorted(map(str, want))


def test_intervals_in_their_bins_are_not_sent_to_all_tasks(spark):
    points = spark.createDataFrame([("a", day(30 * n)) for n in range(12)], "key string, at timestamp")
    long = spark.createDataFrame([("a", "x", day(0), None)], "key string, name string, first timestamp, last timestamp")
    found = covering(points, long, ["key"], "at", "first", "last")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.name for r in found.collect()] == ["x"] * 12


def test_covering_without_rows(spark):
    points = spark.createDataFrame([("a", day(1))], "key string, at timestamp")
    none = spark.createDataFrame([], "key string, name string, first timestamp, last timestamp")
    assert [r.name for r in covering(points, none, ["key"], "at", "first", "last").collect()] == [None]
    some = spark.createDataFrame([("a", "x", day(0), None)], none.schema)
    assert covering(points.filter("false"), some, ["key"], "at", "first", "last").count() == 0
    with pytest.raises(ValueError):
        covering(points, some, ["key"], "at", "first", "last", closed="both")


@pytest.mark.parametrize("task_rows", [60, 5_000_000])
def test_many_instants_find_the_state_in_force(spark, task_rows):
    rng = random.Random(5)
    history, asked = [], []
    for key in ["hot", "b", "c", None]:
        at = 0
        for i in range(120 if key == "hot" else 5):
            until = at + rng.choice([1, 3]) if i % 7 else at + 1
            history.append((key, f"{key}{i}", day(at), None if i == 119 else day(until)))
            at = until + (5 if i % 9 == 8 else 0)  # some gaps
        asked += [(key, day(n), i) for i, n in enumerate([-1, 0, *(rng.randint(0, 300) for _ in range(200 if key == "hot" else 20)), None])]
    asked += [("nobody", day(3), 0), ("hot", day(3), 7), ("hot", day(3), 7)]
    frames = (
        spark.createDataFrame(history, "sub string, plan string, valid_from timestamp, valid_to timestamp"),
        spark.createDataFrame(asked, "sub string, at timestamp, note int").repartition(3),
    )
    found = state_as_of_many(*frames, "sub", task_rows=task_rows)
    assert found.columns == ["sub", "at", "note", "plan", "valid_from", "valid_to"]
    want = []
    for key, at, note in asked:
        own = [h for h in history if h[0] == key and at is not None and h[2] <= at and (h[3] is None or at < h[3])]
        assert len(own) <= 1
        want.append((key, at, note, *(own[0][1:] if own else (None, None, None))))
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("task_rows", [100, 5_000_000])
def test_the_last_known_value(spark, task_rows):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "hot", "k", None]), i, rng.choice([None, None, None, i])) for i in range(1500)]
    frame = spark.createDataFrame(rows, "key string, at int, v int").repartition(4)
    found = with_last_known(frame, "key", ("at",), "v", "last", task_rows)
    last, want = {}, []
    for key, at, v in rows:
        last[key] = v if v is not None else last.get(key)
        want.append((key, at, v, last[key]))
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))
