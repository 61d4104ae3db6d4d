"""Missing values: NULL always, and NaN in floating-point columns."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (FloatType, DoubleType))


def as_numbers(df: DataFrame, *names: str) -> DataFrame:
    """Measures that a schema inference took for text as numbers; other text is NULL."""
    texts = [n for n in names if isinstance(df.schema[n].dataType, StringType)]
    return df.withColumns({n: F.col(n).try_cast("double") for n in texts}) if texts else df


def nan_to_null(df: DataFrame, name: str) -> Column:
    """The column, with NaN read as NULL so that sums and averages skip it."""
    column = F.col(name)
    return F.nanvl(column, F.lit(None)) if _is_floating(df, name) else column


def present(df: DataFrame, *names: str) -> Column:
    """True where none of ``names`` is missing, and never NULL.

    It keeps the rows that ``dropna(subset=names)`` keeps, but as plain NOT NULL
    conjuncts, which reach the scan as pushed filters.
    """
    tests = []
    for name in names:
        tests.append(F.col(name).isNotNull())
        if _is_floating(df, name):
            tests.append(~F.isnan(name))
    return reduce(Column.__and__, tests)
