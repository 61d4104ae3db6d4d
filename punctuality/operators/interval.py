"""How sure an accuracy is: base rate and bootstrap interval, from one aggregation.

In a Poisson bootstrap each replicate counts a row as often as a Poisson number of mean 1 says. The
number comes from a hash of the row's key, so that replicates need no draw and no second pass, are the
same under any partitioning, and a retried task gives the same sums. A row's digest serves eight
replicates with 16 bits each.
"""

from collections.abc import Sequence
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.schema import SEED

PER_DIGEST = 8
# Shares of 65,536 below which a Poisson number of mean 1 is at most 0, 1, 2 and so on.
STEPS = [round(65_536 * exp(-1) * sum(1 / factorial(i) for i in range(k + 1))) for k in range(8)]


def replicate_weights(keys: Sequence[str], replicates: int, seed: int = SEED) -> Column:
    """How often a row counts in each replicate, as an array; from MD5 over the key texts, as other engines have it."""

    def digest(i: int) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(seed + 100 + i)), *[F.col(k).cast("string") for k in keys]))

    def counted(number: Column) -> Column:
        return sum(((number >= s).cast("bigint") for s in STEPS[1:]), (number >= STEPS[0]).cast("bigint"))

    digits = F.concat(*[digest(i) for i in range(-(-replicates // PER_DIGEST))])
    places = F.sequence(F.lit(0), F.lit(replicates - 1))
    # A lambda evaluates what it refers to for each element, so the digits are bound to a name first.
    numbers = F.transform(F.array(digits), lambda d: F.transform(places, lambda b: F.conv(F.substring(d, 4 * b + 1, F.lit(4)), 16, 10).cast("int")))
    return F.transform(F.element_at(numbers, 1), counted)


def accuracy_interval(
    predictions: DataFrame, label: str, prediction: str, keys: Sequence[str], replicates: int = 64,
    per_mille: tuple[int, int] = (25, 975), seed: int = SEED,
) -> DataFrame:
    """``(metric, value)``: rows, accuracy, base rate (the share of the commonest of two classes) and the
    ends of the interval, which are discrete quantiles of the replicates. NULL over no rows."""
    rows = predictions.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    # The rows as they are go with the replicates, as the one in which each counts once.
    weights = F.concat(F.array(F.lit(1).cast("bigint")), replicate_weights(keys, replicates, seed))
    hit = (F.col(label) == F.col(prediction)).cast("bigint")
    weighed = rows.select(hit.alias("hit"), F.col(label).alias("label"), F.posexplode(weights).alias("b", "w")).filter("w > 0")
    sums = weighed.groupBy("b").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("hit")).alias("hits"), F.sum(F.col("w") * F.col("label")).alias("late")
    )
    plain = F.col("b") == 0
    found = sums.select(
        F.max(F.when(plain, F.col("n"))).alias("n"), F.max(F.when(plain, F.col("hits"))).alias("hits"), F.max(F.when(plain, F.col("late"))).alias("late"),
        F.sort_array(F.collect_list(F.when(~plain, F.col("hits") / F.col("n")))).alias("drawn"),
    )

    def end(share: int) -> Column:
        rank = F.ceil(F.size("drawn") * share / F.lit(1000)).cast("int")
        return F.try_element_at("drawn", F.greatest(rank, F.lit(1)))

    late = F.try_divide("late", "n")
    return found.select(
        F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("rows"), F.try_divide("hits", "n").alias("accuracy"),
        F.greatest(late, 1 - late).alias("base_rate"), end(per_mille[0]).alias("low"), end(per_mille[1]).alias("high"),
    ).unpivot([], ["rows", "accuracy", "base_rate", "low", "high"], "metric", "value")
