"""A third of all rows in one group, and a third of them copies of one row."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from punctuality.operators import delays, model, run_log
from punctuality.plans import pipeline
from punctuality.plans import rollup as rolled

ROWS, TASKS = 240_000, 8


@contextmanager
def fixed_plans(spark):
    """Plans as first made, so that their metrics can be read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def shuffled_rows(df):
    """Run ``df`` and return its result rows and the rows that its one shuffle wrote."""
    rows = df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.nodeName() != "Exchange":
        node = node.children().head()
    return rows, node.metrics().apply("shuffleRecordsWritten").value()


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, ROWS, 1, TASKS).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("O"), (i % 50).cast("string"))).alias("ORIGIN"),
        F.when(hot, "Hot").otherwise("Cold").alias("ORIGIN_CITY_NAME"),
        F.lit("D").alias("DEST"),
        F.when(hot, "C0").otherwise(F.concat(F.lit("C"), (i % 9).cast("string"))).alias("OP_UNIQUE_CARRIER"),
        F.when(hot, "2019-07-01").otherwise(F.concat(F.lit("2019-0"), (i % 9 + 1).cast("string"), F.lit("-02")))
        .alias("FL_DATE"),
        F.lit(0.0).alias("CANCELLED"),
        *[F.when(hot, 20.0).otherwise((i % 31).cast("double")).alias(c) for c in ("DEP_DELAY", "ARR_DELAY")],
        F.when(hot, 500.0).otherwise((100 + i % 40).cast("double")).alias("DISTANCE"),
        *[F.lit(1.0).alias(c) for c in (
            "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY")],
        i.alias("flight_id"),
    )


SETTINGS = pipeline.Settings(sample_fraction=0.5, sample_keys=("flight_id",))

JOBS = {
    "origins": delays.origin_delays,
    "rollup": rolled.delay_rollup,
    "refined": lambda df: pipeline.refined_rollup(df, SETTINGS),
    "sample": lambda df: pipeline.model_sample(df, SETTINGS),
    "labels": lambda df: model.with_label(df).groupBy("IS_DELAYED").count(),
}


@pytest.mark.parametrize("name", JOBS)
def test_groups_are_combined_before_the_shuffle(spark, skewed, name):
    with fixed_plans(spark):
        rows, shuffled = shuffled_rows(JOBS[name](skewed))
    # No task sends more than one row per group, so the hot group is as small as the others.
    assert 0 < shuffled <= TASKS * len(rows) < ROWS


def test_hot_group_is_whole(skewed):
    hot = delays.worst_origin(delays.origin_delays(skewed), min_flights=0).first()
    assert (hot.ORIGIN, hot.Total_Flights, hot.Avg_Dep_Delay_Minutes) == ("HOT", ROWS // 3, 20.0)


def test_hot_run_is_combined_before_the_shuffle(spark):
    lines = spark.range(0, ROWS, 1, TASKS).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 40).cast("string")))
        .alias("run_id"),
        F.col("id").alias("line_no"),
        F.when(F.col("id") % 7 == 0, "[PHASE 2] x").otherwise("text").alias("line"),
    )
    with fixed_plans(spark):
        rows, shuffled = shuffled_rows(run_log.step_status(lines))
    assert shuffled <= TASKS * len(rows) / 5


def test_random_draws_split_up_copies(skewed):
    """Copies agree in every key and are drawn together, unless each row is drawn for itself."""
    copies = skewed.drop("flight_id").filter("ORIGIN = 'HOT'")
    together = pipeline.Settings(sample_fraction=0.5)
    apart = pipeline.Settings(sample_fraction=0.5, random_draws=True)
    n = {s: pipeline.with_draws(copies, s).filter("drawn").count() for s in (together, apart)}
    assert n[together] in (0, ROWS // 3)
    assert abs(n[apart] - ROWS / 6) < 1000
