"""Order statistics from value histograms.

A histogram counts the rows of each value of each group: tasks pre-aggregate it, histograms of parts
of a table add up to that of the whole, and no row is sorted and no group gathered. Ranks are found by
prefix sums over coarse steps of values first, then over the values of the one step a rank falls into,
so that neither a group nor the range of its values has to fit into a task.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.functions import as_numbers, nan_to_null

PER_MILLE = {"p50": 500, "p90": 900, "p99": 990}


def value_histogram(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows of each value of each group as ``(*by, value, n)``; missing values are left out."""
    df = as_numbers(df, value)
    rows = df.select(*by, (nan_to_null(df, value) + F.lit(0.0)).alias("value")).filter("value IS NOT NULL")
    return rows.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """The histogram of all rows from those of parts of them."""
    return reduce(DataFrame.unionByName, parts).groupBy(*by, "value").agg(F.sum("n").alias("n"))


def quantiles(
    histogram: DataFrame, by: Sequence[str], per_mille: Mapping[str, int] = PER_MILLE, step: float = 60.0
) -> DataFrame:
    """Rows and discrete quantiles of each group, from :func:`value_histogram`, as ``(*by, n, ...)``.

    A quantile is the smallest value that the given share of the group's rows does not exceed.
    ``step`` is the width of a coarse step of values. NULL is a group like any other.
    """
    names = [f"_by{i}" for i in range(len(by))]
    bins = histogram.select(*[F.col(c).alias(k) for c, k in zip(by, names, strict=True)], "value", "n")
    bins = bins.withColumn("_step", F.floor(F.col("value") / step))
    group = Window.partitionBy(*names)
    steps = bins.groupBy(*names, "_step").agg(F.sum("n").alias("in_step"))
    steps = steps.withColumns({
        "upto": F.sum("in_step").over(group.orderBy("_step")), "total": F.sum("in_step").over(group),
    })
    # The rank of a share of n rows is that share, rounded up.
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.ceil(F.col("total") * share / F.lit(1000)).cast("bigint").alias("rank"))
        for name, share in per_mille.items()
    ])
    keys = [*names, "_step"]
    asked = steps.select(
        *[F.col(k).alias(f"_of{k}") for k in keys], "total", (F.col("upto") - F.col("in_step")).alias("before"), "upto", F.inline(wanted)
    ).filter("rank <= upto AND rank > before")
    same = [asked[f"_of{k}"].eqNullSafe(bins[k]) for k in keys]
    inside = bins.join(asked, same).select(*names, "name", "rank", "total", "before", "value", "n")
    along = Window.partitionBy(*names, "name").orderBy("value")
    reached = inside.withColumn("reached", F.col("before") + F.sum("n").over(along)).filter("reached >= rank")
    shown = [F.min(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in per_mille]
    found = reached.groupBy(*names).agg(F.max("total").alias("n"), *shown)
    return found.select(*[F.col(k).alias(c) for c, k in zip(by, names, strict=True)], "n", *per_mille)
