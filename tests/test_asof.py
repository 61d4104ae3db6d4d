"""The as-of join against a plain search of each record's state."""

import datetime as dt
import random

import pytest

from punctuality.operators.asof import as_of_join

DAY0 = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def brute(records, states, exact=True, tolerance=None):
    out = []
    for name, key, time in records:
        best = None
        if key is not None and time is not None:
            held = [
                s for s in states
                if s[0] == key and s[1] is not None and (s[1] < time or exact and s[1] == time)
            ]
            # The last moment, then the last by number; NULL is before all numbers.
            best = max(held, key=lambda s: (s[1], s[2]), default=None)
            if best and tolerance is not None and (time - best[1]).total_seconds() > tolerance:
                best = None
        out.append((name, key, time, best and best[1], best and best[3]))
    return sorted(out, key=repr)


def frames(spark, records, states, kind="date"):
    left = spark.createDataFrame(records, f"name int, k string, t {kind}")
    right = spark.createDataFrame(states, f"k string, at {kind}, nr int, price double")
    return left, right


def joined(left, right, **options):
    found = as_of_join(left, right, ["k"], "t", "at", {"at": "price_at", "price": "price"}, order=["nr"], **options)
    assert found.columns == ["name", "k", "t", "price_at", "price"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("width", [86_400.0, 7 * 86_400.0, 1e9])
def test_as_of_days(spark, exact, width):
    rng = random.Random(1)
    keys = ["a", "b", "c", None, "only left"]
    records = [(i, rng.choice(keys), day(rng.choice([None, *range(-20, 120)]))) for i in range(300)]
    states = [(rng.choice(["a", "b", None, "only right"]), day(rng.choice([None, *range(0, 100, 3)])), i, rng.choice([None, float(i)])) for i in range(80)]
    left, right = frames(spark, records, states)
    assert joined(left, right, exact=exact, slice_width=width) == brute(records, states, exact)
    assert joined(left, right, exact=exact, slice_width=width, tolerance=5 * 86_400) == brute(records, states, exact, 5 * 86_400)


def test_as_of_moments_before_the_epoch(spark):
    rng = random.Random(2)
    base = dt.datetime(1969, 12, 31, 12)
    moment = lambda: base + dt.timedelta(microseconds=rng.randrange(0, 10**11, 250_001))
    records = [(i, rng.choice("xy"), moment()) for i in range(200)]
    states = [(rng.choice("xy"), moment(), i, float(i)) for i in range(60)]
    records += [(1000 + i, s[0], s[1]) for i, s in enumerate(states[:20])]  # exactly at a state
    left, right = frames(spark, records, states, "timestamp")
    assert joined(left, right, slice_width=3600) == brute(records, states)


def test_hot_key_is_dealt_over_slices(spark):
    """A key with nearly all records, most at one moment: no task orders more than a slice of moments."""
    records = [(i, "hot", day(i % 400)) for i in range(3000)] + [(3000 + i, "hot", day(7)) for i in range(3000)] + [(9000, "cold", day(3))]
    states = [("hot", day(n), n, float(n)) for n in range(0, 400, 2)] + [("cold", day(1), 1, 0.5)]
    left, right = frames(spark, records, states)
    assert joined(left, right, slice_width=10 * 86_400.0) == brute(records, states)
    plan = as_of_join(left, right, ["k"], "t", "at", ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "_key0" in plan and "_slice" in plan and "CartesianProduct" not in plan and "Python" not in plan
    windows = [line for line in plan.splitlines() if "Window" in line and "_time" in line]
    assert windows and all("_slice" in line for line in windows)


def test_as_of_states_repeated_and_empty(spark):
    records = [(1, "a", day(5)), (1, "a", day(5)), (2, "b", day(5))]
    states = [("a", day(5), 1, 1.0), ("a", day(5), 2, 2.0), ("a", day(5), 2, 2.0)]
    left, right = frames(spark, records, states)
    assert joined(left, right) == brute(records, states)
    assert joined(left, right.limit(0)) == brute(records, [])
    assert joined(left.limit(0), right) == []


def test_as_of_refuses_what_it_cannot_mean(spark):
    left, right = frames(spark, [(1, "a", day(1))], [("a", day(1), 1, 1.0)])
    with pytest.raises(ValueError, match="names"):
        as_of_join(left, right, ["k"], "t", "at", {"price": "name"})
    with pytest.raises(TypeError, match="differ"):
        as_of_join(left, right.withColumn("at", right["at"].cast("timestamp")), ["k"], "t", "at", ["price"])
    with pytest.raises(TypeError, match="no date"):
        as_of_join(left.withColumnRenamed("k", "x").withColumnRenamed("t", "k"), right.withColumnRenamed("k", "z"), [], "x", "z", ["price"])
