"""Counts taken from a write that happens anyway.

Metrics belong into the stage that writes: there Spark counts each task once, whatever was retried.
Before a shuffle, a task whose output is lost with its executor runs again and would count again.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from punctuality.sources.flights import land


def counts_of(spark: SparkSession, observation: Observation, stages: Mapping[str, Column]) -> DataFrame:
    """``(stage, n)`` of an observation whose action has ended; one row for each stage."""
    found = observation.get
    return spark.createDataFrame([(stage, int(found.get(stage) or 0)) for stage in stages], "stage string, n bigint")


def land_counted(df: DataFrame, path: str, stages: Mapping[str, Column], **options) -> DataFrame:
    """:func:`~punctuality.sources.flights.land`, and the counts of ``stages`` from the same pass."""
    observation = Observation("landing")
    counts = [F.count_if(test).alias(stage) for stage, test in stages.items()]
    # Behind the exchange that evens out the files, in the writing stage.
    land(df, path, then=lambda rows: rows.observe(observation, *counts), **options)
    return counts_of(df.sparkSession, observation, stages)
