"""Order statistics from histograms, against sorting."""

import math

import numpy as np

from punctuality.operators.quantiles import PER_MILLE, merge_histograms, quantiles, value_histogram


def sorted_quantiles(rows):
    groups = {}
    for key, value in rows:
        if value is not None and not math.isnan(value):
            groups.setdefault(key, []).append(value)
    return sorted(
        ((k, len(v), *(sorted(v)[-(-len(v) * share // 1000) - 1] for share in PER_MILLE.values())) for k, v in groups.items()), key=repr
    )


def drawn(n=4000):
    rng = np.random.default_rng(1)
    keys, rows = ["a", "b", "c", None], []
    for i in range(n):
        key = keys[min(3, int(rng.exponential(0.7)))]
        value = None if i % 31 == 0 else float("nan") if i % 37 == 0 else float(rng.integers(-500, 900)) / 4
        rows.append((key, value))
    return [*rows, ("single", 3.0), ("nothing", None), ("same", 5.0), ("same", 5.0), ("zero", -0.0), ("zero", 0.0)]


def found_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_quantiles_are_those_of_sorted_values(spark):
    rows = drawn()
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    for step in (60.0, 0.25, 1e6):
        assert found_of(quantiles(value_histogram(df, ["k"], "v"), ["k"], step=step)) == sorted_quantiles(rows)


def test_histograms_of_parts_add_up(spark):
    rows = drawn(600)
    df = spark.createDataFrame(rows, "k string, v double")
    whole = value_histogram(df, ["k"], "v")
    parts = [value_histogram(part, ["k"], "v") for part in df.randomSplit([0.2, 0.3, 0.5], seed=3)]
    merged = merge_histograms(parts, ["k"])
    assert found_of(merged) == found_of(whole)
    assert found_of(quantiles(merged, ["k"])) == sorted_quantiles(rows)


def test_quantiles_of_whole_tables_and_no_rows(spark):
    df = spark.createDataFrame(drawn(500), "k string, v double")
    everything = [(1, v) for _, v in drawn(500)]
    assert found_of(quantiles(value_histogram(df, [], "v"), [])) == [r[1:] for r in sorted_quantiles(everything)]
    assert quantiles(value_histogram(df.limit(0), ["k"], "v"), ["k"]).count() == 0
    texts = spark.createDataFrame([("a", "1.5"), ("a", "n/a"), ("a", "2.5")], "k string, v string")
    assert found_of(quantiles(value_histogram(texts, ["k"], "v"), ["k"], {"p50": 500, "max": 1000})) == [("a", 2, 1.5, 2.5)]


def test_rows_are_counted_before_they_move(spark):
    """One exchange for the histogram, with counting on both sides; no sort of rows."""
    df = spark.range(1000).selectExpr("id % 3 AS k", "CAST(id % 50 AS DOUBLE) AS v")
    plan = value_histogram(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1 and "Sort " not in plan
