"""Pruning and cleaning."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions import present
from punctuality.schema import CAUSES, FLOAT_MEASURES, NEEDED_COLUMNS, REQUIRED_COLUMNS


def prune(df: DataFrame, needed: Sequence[str] = NEEDED_COLUMNS) -> DataFrame:
    """Keep the needed columns, in the order given, as far as they exist."""
    return df.select(*[name for name in needed if name in df.columns])


def is_flown(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    cancelled: str = "CANCELLED",
) -> Column:
    """True for a record that cleaning keeps, false for all others, and never NULL.

    A record counts as flown only where the flag is 0: an unknown flag drops it too.
    """
    return F.coalesce(F.col(cancelled) == 0, F.lit(False)) & present(df, *required)


def clean(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    fill: Sequence[str] = tuple(CAUSES),
    measures: Sequence[str] = FLOAT_MEASURES,
    cancelled: str = "CANCELLED",
) -> DataFrame:
    """Flown records with all required values; missing cause minutes become 0.

    Columns outside ``required`` and ``fill`` may stay NULL.
    """
    return (
        df.filter((F.col(cancelled) == 0) & present(df, *required))
        .drop(cancelled)
        .fillna(0, subset=list(fill))
        .withColumns({name: F.col(name).cast("float") for name in measures})
    )
