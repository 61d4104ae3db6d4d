"""Samples and splits.

``sample_rows`` and ``split_rows`` draw at random per partition: the rows they pick
change with the partitioning, and the split sorts every partition. The ``*_by_key``
forms decide by a hash of each row, so they give the same rows under any layout and
after any task retry, and cost no shuffle and no sort.

Rows with equal keys stay together. The key should therefore identify a row; it is
all columns unless given.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions.hashing import BUCKETS, row_bucket
from punctuality.schema import SAMPLE_FRACTION, SEED, SPLIT_WEIGHTS


def sample_rows(
    df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SEED
) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_rows(
    df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = SEED
) -> list[DataFrame]:
    """Random split in proportion to the weights."""
    return df.randomSplit(list(weights), seed=seed)


def in_sample(
    keys: Sequence[str], fraction: float, seed: int = SEED, portable: bool = False
) -> Column:
    """Predicate of :func:`sample_by_key`."""
    return row_bucket(keys, seed, portable) < round(fraction * BUCKETS)


def sample_by_key(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    keys: Sequence[str] | None = None,
    seed: int = SEED,
    portable: bool = False,
) -> DataFrame:
    """Keep the rows whose key hash falls in the first ``fraction`` of the range."""
    return df.filter(in_sample(keys or df.columns, fraction, seed, portable))


def split_number(
    keys: Sequence[str],
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: int = SEED,
    portable: bool = False,
) -> Column:
    """Index of the part a row belongs to.

    The seed is shifted so that the split is independent of a sample drawn with
    the same seed and key.
    """
    bucket = row_bucket(keys, seed + 1, portable)
    total, upper, number = sum(weights), 0.0, F.lit(0)
    for weight in weights[:-1]:
        upper += weight / total
        number = number + (bucket >= round(upper * BUCKETS)).cast("int")
    return number


def split_by_key(
    df: DataFrame,
    weights: Sequence[float] = SPLIT_WEIGHTS,
    keys: Sequence[str] | None = None,
    seed: int = SEED,
    portable: bool = False,
) -> list[DataFrame]:
    """Split in proportion to the weights by key hash."""
    number = split_number(keys or df.columns, weights, seed, portable)
    return [df.filter(number == part) for part in range(len(weights))]
