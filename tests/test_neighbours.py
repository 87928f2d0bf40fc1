import random

import pytest

from subtally.operators import neighbours
from subtally.operators.neighbours import large_keys, with_neighbours


def skewed(spark):
    """One key with half the rows, many of them at the same instant, NULL times and a NULL key with many rows."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([1, 5, 5, 5, rng.randint(0, 400), None]), f"e{i:05d}") for i in range(3000)]
    rows += [(None, rng.randint(0, 90), f"e{i:05d}") for i in range(3000, 4200)]
    rows += [(f"k{rng.randrange(300)}", rng.randint(0, 50), f"e{i:05d}") for i in range(4200, 6000)]
    return rows, spark.createDataFrame(rows, "key string, at int, id string")


def by_hand(rows):
    found, ordered = [], {}
    for key, at, name in rows:
        ordered.setdefault(key, []).append((at is None, at or 0, name, at))
    for key, own in ordered.items():
        own = [(at, name) for _, _, name, at in sorted(own)]
        for before, now, after in zip([None, *own], own, [*own[1:], None]):
            found.append((key, *now, before, after))
    return sorted(found, key=str)


@pytest.mark.parametrize("task_rows", [250, neighbours.TASK_ROWS])
def test_neighbours_whatever_a_task_may_hold(spark, task_rows):
    rows, frame = skewed(spark)
    large = {r["_key"] for r in large_keys(frame, "key", task_rows).collect()}
    assert large == ({"hot", None} if task_rows == 250 else set())
    out = with_neighbours(frame, "key", ("at", "id"), ("at", "id"), previous="p", following="n", task_rows=task_rows)
    got = [(r.key, r.at, r.id, r.p and tuple(r.p), r.n and tuple(r.n)) for r in out.collect()]
    assert sorted(got, key=str) == by_hand(rows)


def test_one_side_only_and_no_rows(spark):
    _, frame = skewed(spark)
    assert "n" in with_neighbours(frame, "key", ("at", "id"), ("id",), following="n", task_rows=500).columns
    assert with_neighbours(frame.filter("false"), "key", ("at", "id"), ("id",), previous="p").count() == 0
