"""Many categories as numbers: out-of-fold means of the label.

A tree takes a category apart bin by bin, and has few bins; beyond them an index by frequency is all
but noise. Here a category becomes the share of late rows it has in the other folds, so that a row's
own label is never in its own feature. Folds go by a hash of the row's key. The means are counted on
one row per category and fold, however many rows there are.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.functions.hashing import row_bucket
from punctuality.schema import SEED

FOLDS, WEIGHT = 5, 20.0


def fold_means(
    rows: DataFrame, category: str, label: str, fold: str, weight: float = WEIGHT, count: str | None = None
) -> DataFrame:
    """``(category, fold, mean)``: the mean label of a category in all folds but one, drawn towards the
    mean of all rows as by ``weight`` rows of it. ``count`` says how often a row counts, as in a tally.

    There is a row for each fold of each category; a category or label that is missing is left out.
    """
    n = F.lit(1) if count is None else F.col(count)
    known = rows.filter(F.col(category).isNotNull() & F.col(label).isNotNull())
    cells = known.groupBy(F.col(category).alias("category"), F.col(fold).alias("fold")).agg(
        F.sum(n).alias("n"), F.sum(F.col(label) * n).alias("hits")
    )
    whole = cells.groupBy("category").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "hits")))).alias("own"),
    )
    # The sums of all rows come from the categories' sums, as scalar subqueries.
    prior = whole.select(F.sum("hits") / F.sum("n")).scalar()
    folds = rows.select(F.col(fold).alias("fold")).distinct()
    listed = folds.select(F.sort_array(F.collect_set("fold"))).scalar()
    spread = whole.select("category", "n", "hits", "own", F.explode(listed).alias("fold"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("hits"))
    own = F.coalesce(F.col("own")[F.col("fold")], nothing.cast(spread.schema["own"].dataType.valueType))
    hits, others = F.col("hits") - own["hits"], F.col("n") - own["n"]
    return spread.select("category", "fold", ((hits + prior * weight) / (others + weight)).alias("mean"))


def encode(
    rows: DataFrame, category: str, label: str, keys: Sequence[str], name: str,
    folds: int = FOLDS, weight: float = WEIGHT, seed: int = SEED, portable: bool = False,
) -> DataFrame:
    """``rows`` with the column ``name``: the mean of their category outside their own fold.

    Rows without a category have NULL. A row without a label takes no part in the means.
    """
    folded = rows.withColumn("_fold", F.pmod(row_bucket(keys, seed + 2, portable), F.lit(folds)).cast("int"))
    means = fold_means(folded, category, label, "_fold", weight)
    same = [folded[category] == means["category"], folded["_fold"] == means["fold"]]
    return folded.join(means, same, "left").withColumn(name, F.col("mean")).drop("category", "fold", "mean", "_fold")
