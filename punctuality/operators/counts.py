"""Row counts."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows passing each stage as ``(stage, n)``, all counted in one scan.

    A stage is a predicate over ``df``; use ``F.lit(True)`` for all rows.
    """
    counted = df.select(*[F.count_if(test).alias(stage) for stage, test in stages.items()])
    return counted.unpivot([], list(stages), "stage", "n")


def label_counts(labelled: DataFrame, label: str = "IS_DELAYED") -> DataFrame:
    """Rows per class as ``(label, n)``."""
    return labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
