"""Samples and splits with an exact number of rows from each stratum.

A row is drawn if its key's hash is among the smallest of its stratum, as many as the quota says. The
hash that ends the quota is found without a sort: a histogram of hash prefixes, which tasks
pre-aggregate, tells in which prefix it lies, and only the rows of that one prefix, some 65,000th of a
stratum, are ranked. So two passes over the rows do, and a stratum may hold any part of them.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.functions.hashing import BUCKETS, row_bucket
from punctuality.schema import SEED

PREFIXES = 1 << 16
CHOSEN = "chosen"


def quota_of(rows: Column, per_mille: int) -> Column:
    """The share of a number of rows, rounded to the nearest, halves up."""
    return F.floor((rows * per_mille + 500) / F.lit(1000)).cast("bigint")


def with_quota(
    df: DataFrame, by: Sequence[str], keys: Sequence[str], per_mille: int, seed: int = SEED, portable: bool = False
) -> DataFrame:
    """``df`` with ``chosen``: true for exactly the quota of each stratum ``by``, false for the others.

    ``keys`` should identify a row. Rows of one hash go by all their columns; equal rows can't be told
    apart, and any of them are chosen, as many as the quota lacks. NULL is a stratum like any other.
    """
    if CHOSEN in df.columns:
        raise ValueError(f"there is a column {CHOSEN} already")
    strata = [f"_by{i}" for i in range(len(by))]
    rows = df.withColumns({
        **{s: F.col(c) for s, c in zip(strata, by, strict=True)}, "_hash": row_bucket(keys, seed, portable),
    }).withColumn("_prefix", F.floor(F.col("_hash") / (BUCKETS // PREFIXES)).cast("int"))
    prefixes = rows.groupBy(*strata, "_prefix").agg(F.count(F.lit(1)).alias("n"))
    stratum = Window.partitionBy(*strata)
    upto = F.sum("n").over(stratum.orderBy("_prefix"))
    prefixes = prefixes.withColumns({"upto": upto, "total": F.sum("n").over(stratum)})
    prefixes = prefixes.withColumns({"quota": quota_of(F.col("total"), per_mille), "before": F.col("upto") - F.col("n")})
    # The prefix in which the quota ends: the last one that begins below it, or the first if it is 0.
    ends = prefixes.filter("before < quota OR before = 0").groupBy(*[F.col(s).alias(f"_of{s}") for s in strata]).agg(
        F.max("_prefix").alias("_end"), F.max_by(F.col("quota") - F.col("before"), "_prefix").alias("_left")
    )
    met = rows.join(ends, [rows[s].eqNullSafe(ends[f"_of{s}"]) for s in strata] or F.lit(True))
    inside = met.filter("_prefix <> _end").withColumn(CHOSEN, F.col("_prefix") < F.col("_end"))
    place = F.row_number().over(Window.partitionBy(*strata).orderBy("_hash", *[F.col(c) for c in _sortable(df)]))
    border = met.filter("_prefix = _end").withColumn(CHOSEN, place <= F.col("_left"))
    return inside.unionByName(border).select(*[F.col(c) for c in df.columns], CHOSEN)


def _sortable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]


def stratified_sample(
    df: DataFrame, by: Sequence[str], keys: Sequence[str], per_mille: int, seed: int = SEED, portable: bool = False
) -> DataFrame:
    """The chosen rows of :func:`with_quota`."""
    return with_quota(df, by, keys, per_mille, seed, portable).filter(CHOSEN).drop(CHOSEN)
